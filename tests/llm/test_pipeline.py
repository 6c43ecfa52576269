"""The pipeline on the smallest tables, each stage against what its operator has to do."""

import pytest
from conftest import SMALL


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline as p

    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = [docs]
    for k, (_, f) in enumerate(p.STAGES):
        f(spark, docs, SMALL).write.parquet(str(out / str(k)))
        docs = spark.read.parquet(str(out / str(k)))
        held.append(docs)
    return held


def test_order_and_columns(stages):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    for d in stages[1:-1]:
        assert d.dtypes == stages[0].dtypes


def test_each_stage_is_written(spark, monkeypatch):
    import corpus_pipeline as p

    read = []
    stage = lambda s, docs, d: read.append(docs.inputFiles()) or docs.limit(5)
    monkeypatch.setattr(p, "STAGES", [("one", stage), ("two", stage)])
    out = p.run(spark, SMALL)
    assert out.count() == 5 and "/one-" in read[1][0] and "/two-" in out.inputFiles()[0]


def test_documents_without_id_stay(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    rows = [(None, f"words of number {i} that stand nowhere else in this table", "en", "s", 60) for i in ("one", "two")] + [(None, None, "en", "s", 0)]
    given = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for _, stage in p.STAGES[:3]:
        given = stage(spark, given, SMALL)
        assert {r["text"] for r in given.where("doc_id is null").collect()} >= {rows[0][1], rows[1][1]}


def test_clean_documents_stay(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1].select("doc_id").collect()}
    clean, bad = [i for i, t in labels.items() if not t], [i for i, t in labels.items() if t]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean) and sum(i in kept for i in bad) <= 0.5 * len(bad)


def test_one_of_each_class(stages):
    from test_dedup import grams

    before, after = ({r["doc_id"]: grams(r["text"]) for r in d.collect()} for d in stages[1:3])
    near = lambda a, b: (not a and not b) or len(a & b) >= 0.8 * len(a | b) - 1e-9
    for i, x in before.items():
        if i not in after:
            assert any(j < i and near(x, y) for j, y in before.items())
    rest = sorted(after.items())
    for k, (_, x) in enumerate(rest):
        assert not any(near(x, y) for _, y in rest[k + 1 :])


def test_no_repeats_left_in_place(stages):
    from collections import Counter

    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    data = {i: (t or "").encode() for i, t in before.items()}
    count = Counter(b[s : s + 200] for b in data.values() for s in range(len(b) - 199))
    for r in stages[3].collect():
        b, gone = data[r["doc_id"]], set()
        for s in range(len(b) - 199):
            if count[b[s : s + 200]] > 1:
                gone.update(range(s, s + 200))
        assert r["text"] == bytes(x for p, x in enumerate(b) if p not in gone).decode(errors="ignore") and r["n_chars"] == len(r["text"])


def test_packed(stages):
    got = stages[4].collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in stages[3].select("doc_id").collect()}
    fill: dict = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert fill.get(r["sequence_id"], 0) == r["offset"]
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 2
