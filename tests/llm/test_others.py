import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from evgraph.llm import grammar, knn, lm, spotsigs, toxicity, warc


# ---------------------------------------------------------------- nearest neighbours


@pytest.mark.parametrize("cells", [1, 3])
def test_search(spark, cells, monkeypatch):
    monkeypatch.setattr(knn, "CELL_QUERIES", 2)
    r = random.Random(7)
    nan, inf = float("nan"), float("inf")
    vec = lambda: [r.gauss(0, 1) for _ in range(6)]
    same = vec()
    rows = [(i, vec(), "z") for i in range(260)] + [(i, same, "z") for i in range(300, 330)] + [(1000, None, "z"), (1001, [], "z"), (1050, [nan] * 6, "z"), (1100, [inf] * 6, "z"), (1150, [None] * 6, "z"), (1200, [1.0], "z"), (None, vec(), "z"), (7, vec(), "z")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string").repartition(4)
    good = [(x["vec_id"], [int(__import__("math").floor(256 * v)) for v in x["embedding"]]) for x in table.collect() if x["vec_id"] is not None and x["embedding"] and len(x["embedding"]) == 6 and all(v is not None and abs(v) < inf for v in x["embedding"])]
    want = set()
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = knn.search(table, F.pmod(F.col("id"), F.lit(50)) == 0, queries_a_cell=max(1, 7 // cells))
    assert {tuple(x) for x in got.collect()} == want
    few = knn.search(table.where("vec_id in (0, 1, 2)"), F.pmod(F.col("id"), F.lit(50)) == 0)
    assert few.count() == 2
    assert knn.search(table.limit(0), F.lit(True)).count() == 0 and knn.search(table.where("vec_id = 3"), F.pmod(F.col("id"), F.lit(50)) == 0).count() == 0


def test_query_groups_that_need_the_same_rows_travel_together():
    weight, queries = np.full(10, 1000.0), np.full(6, 256)
    everything = np.ones((6, 10), dtype=bool)
    assert sorted(map(sorted, knn.together(everything, weight, queries, 10_000))) == [[0, 1, 2, 3, 4, 5]]
    assert sorted(map(len, knn.together(everything, weight, queries, 600))) == [2, 2, 2]  # a union is no larger than a task may hold
    apart = np.zeros((6, 10), dtype=bool)
    for g in range(6):
        apart[g, g] = True
    assert sorted(knn.together(apart, weight, queries, 10_000)) == [[g] for g in range(6)]
    half = apart.copy()
    half[:3, 6:] = True
    found = sorted(map(sorted, knn.together(half, weight, queries, 10_000)))
    assert found == [[0, 1, 2], [3], [4], [5]]
    # rows that travel: never more than once for each group, nor more than all rows for each task of queries
    r = np.random.default_rng(5)
    for share in (0.02, 0.3, 0.9, 1.0):
        needed, weight, queries = r.random((60, 200)) < share, r.integers(1, 500, 200).astype(float), r.integers(1, 400, 60)
        unions = knn.together(needed, weight, queries, 2000)
        sent = sum(needed[m].any(0) @ weight for m in unions)
        assert sorted(g for m in unions for g in m) == list(range(60)) and sent <= (needed @ weight).sum() and all(queries[m].sum() <= 2000 for m in unions)
        if share >= 0.9:
            assert sent <= weight.sum() * (2 * queries.sum() / 2000 + 1)


@pytest.mark.parametrize("block", [40_000, 8])
def test_search_with_repeated_rows(spark, block, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    near, same = [3.0, 0.0], [2.0, 0.0]
    rows = [(0, [1.0, 0.0])] * 3 + [(1, near)] * 6 + [(2, same)] * 6 + [(i, same) for i in range(3, 7)] + [(i, [0.1, 0.1 * i]) for i in range(7, 30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = knn.search(table, F.col("id") == 0, scale=10.0)
    # each row is a candidate, as in the SQL: the row that repeats six times takes all five places
    assert sorted(tuple(x) for x in got.collect()) == [(0, n, 1, 300) for n in range(1, 6)]
    got = knn.search(table.where("vec_id <> 1").unionByName(table.where("vec_id = 1").limit(2)), F.col("id") == 0, scale=10.0)
    assert sorted(tuple(x) for x in got.collect()) == [(0, 1, 1, 300), (0, 2, 1, 300), *[(0, n, 2, 200) for n in range(3, 6)]]


@pytest.mark.parametrize("size", [1.0, 1e4, 1e7, 1e10])
def test_search_is_exact_for_large_components(spark, size, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 20)
    r = random.Random(3)
    rows = [(i, [size * r.choice((-1, 1, 0.5, 3)) * r.random() for _ in range(4)]) for i in range(90)]
    rows += rows[5:9] + [(i, [x + y for x, y in zip(rows[7][1], (0.004, 0, 0, 0), strict=True)]) for i in range(100, 104)]
    r.shuffle(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for q, v in whole:
        if q % 10 == 0 and q < 90:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)[:5]
            want += [(q, n + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(found)]
    got = knn.search(table, (F.pmod(F.col("id"), F.lit(10)) == 0) & (F.col("id") < 90), pivots=7, queries_a_cell=2)
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


# ---------------------------------------------------------------- archives


def test_archives(spark):
    big, other = "é<html>\r\n\r\nWARC/1.0\r\n" * 80, "b" * 1000
    rows = [(1, "u1", big), (2, "u2", big), (9, "u9", big), (3, "u\r\n3", other), (4, None, other), (5, "u5", "b" * 999), (6, "u6", "b" * 999), (7, "u7", None), (8, "u8", ""), (None, "un", other), (9, "u9", big), (10, "u", "x" * 200_000), (None, "n", "n" * 1500), (None, "m", "n" * 1500)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    keeper = defaultdict(lambda: -1)
    for i, _, h in rows:
        keeper[h or ""] = max(keeper[h or ""], -1 if i is None else i)
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and keeper[h or ""] >= 0 and keeper[h or ""] != i
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", keeper[h or ""] if again else None] += 1
    out = warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r) for r in out.collect()) == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a\r\n\r\nb"), (2, "v", "é" * 700), (3, "w", "é" * 700)], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    got = {r["page_id"]: r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert got[1]["payload"] == "a\r\n\r\nb" and got[3]["payload"] == "é" * 700 and got[2]["payload"] is None
    assert got[2]["refers_to_id"] == got[3]["record_id"] and got[3]["record_type"] == "response"


def test_each_record_is_a_gzip_member(spark, tmp_path):
    """Members of an archive are read one by one: each holds one whole record, whatever its size (16 MB and more: an empty member follows)."""
    rows = [(1, "u", "a" * 3000), (2, "v", "a" * 3000), (3, "w", "é\0\n" * 5_000_000), (4, "x", ""), (5, "y", None)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    found = []
    for file in (tmp_path / "w").glob("part-*"):
        raw = file.read_bytes()
        while raw:
            one = zlib.decompressobj(31)
            record = one.decompress(raw)
            assert one.eof
            raw = one.unused_data
            if record:
                fields, block = next(warc.parse(record))
                assert record.startswith(b"WARC/1.0\r\n") and record.endswith(block + b"\r\n\r\n") and record.count(b"WARC-Record-ID") == 1
                found.append((int(fields["x-page-id"]), fields["warc-type"], len(block.partition(b"\r\n\r\n")[2])))
    assert sorted(found) == [(1, "revisit", 0), (2, "response", 3000), (3, "response", 20_000_000), (4, "response", 0), (5, "response", 0)]


def test_archives_are_bounded(spark, tmp_path, monkeypatch):
    """Few large pages among many small ones: an archive grows by its largest page at most, and reads back whole."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 20)
    r = random.Random(4)
    noise = lambda n: "".join(map(chr, r.choices(range(33, 127), k=n)))
    rows = [(i, "u", noise(20_000)) for i in range(300)] + [(1000 + i, "u", noise(4_000_000)) for i in range(4)] + [(2000, "u", "z" * 100_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = str(tmp_path / "warc")
    warc.write(pages, path)
    files = [(f, sum(len(b) for _, b in warc.parse(f.read_bytes()))) for f in (tmp_path / "warc").glob("part-*")]
    sizes = sorted(n for _, n in files)
    assert sum(sizes) > 120_000_000 and sizes[-1] < 102_000_000 and all(n < 12_000_000 for n in sizes[:-1]) and len(files) > 30
    got = {x["page_id"]: x["payload_digest"] for x in warc.read(spark, path, payloads=False).collect()}
    assert got == {i: hashlib.sha1(h.encode()).hexdigest() for i, _, h in rows}


# ---------------------------------------------------------------- toxicity


def test_composition_equals_one_transducer_after_another():
    """Each path of the composed table, against the five transducers run one after another."""
    after, written, events = grammar.compose()
    start = tuple(x for x, _ in grammar.CASCADE)
    r = random.Random(5)
    paths = [p for n in range(1, 5) for p in itertools.product(range(len(grammar.KINDS)), repeat=n)] + [tuple(r.randrange(len(grammar.KINDS)) for _ in range(40)) for _ in range(300)]
    for path in paths:
        state, states, got, want = 0, start, [], []
        for kind in path:
            got.append(events[written[state][kind]] if written[state][kind] >= 0 else None)
            state = after[state][kind]
            symbol, new = grammar.plain(grammar.KINDS[kind]), []
            for own, (_, step) in zip(states, grammar.CASCADE, strict=True):
                own, symbol = step(own, symbol)
                new.append(own)
            states = tuple(new)
            want.append(symbol if symbol[0] in grammar.HURTS else None)
        assert got == want
    assert all(after[s][grammar.KINDS.index("end")] == 0 for s in range(len(after)))


def clause_events(kinds):
    """What a clause's words say, told from the words around each and not by states."""
    out, insults = [], 0
    near = lambda kind, i, reach: kind in kinds[max(0, i - reach) : i]
    hurts = [i for i, k in enumerate(kinds) if k in grammar.HURTS]
    marks = {i: frozenset(["reported"] * ("report" in kinds[:i]) + ["negated"] * near("negation", i, grammar.REACH) + ["targeted"] * near("target", i, grammar.TARGET_REACH)) for i in hurts}
    for i, kind in enumerate(kinds):
        if kind == "insult":
            out.append((kind, marks[i] | ({"again"} if insults else set())))
            insults += 1
        if kind == "threat" and "targeted" in marks[i]:
            out.append((kind, marks[i]))
        last = max((j for j in hurts if j < i), default=None)
        if kind == "target" and last is not None and i - last <= grammar.TARGET_REACH and "target" not in kinds[last:i] and "targeted" not in marks[last]:
            out.append((kinds[last], marks[last] | {"targeted", "late"}))
    return out


def test_scores_by_brute_force(spark):
    """Scores of random clauses: words told from their neighbours, fixed weights, the logistic curve."""
    words = {"insult": ["idiot", "losers", "grimox"], "threat": ["kill", "burning"], "target": ["you", "tú"], "negation": ["not", "kein"], "report": ["said", "wrote"], "other": ["lamp", "über", "x1", "killjoy"], "end": [".", "!", "\n", ";"]}
    g, r = toxicity.Grammar(frozenset({"idiot", "loser"}), frozenset({"grimo"})), random.Random(8)
    weight = dict(zip(toxicity.EVENTS, g.weights[1:], strict=True))
    rows, want = [], {}
    for n in range(1500):
        kinds = r.choices(list(words), weights=r.choice(((3, 3, 3, 2, 2, 9, 2), (1, 1, 1, 1, 1, 30, 4))), k=r.choice((1, 5, 12, 60)))
        rows.append((n, " ".join(r.choice(words[k]) for k in kinds)))
        found, clause = Counter(), []
        for k in [*kinds, "end"]:
            if k == "end":
                found.update(clause_events(clause))
                clause = []
            else:
                clause.append(k)
        odds = g.weights[0] + sum(weight[e] * (1 + math.log(c)) for e, c in found.items())
        want[n] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    got = {x["id"]: x["score"] for x in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), g).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[n], want[n], rel_tol=1e-9) for n in want)
    assert sum(v >= 0.5 for v in want.values()) > 300 and sum(v < 0.5 for v in want.values()) > 300


def test_clauses():
    g = toxicity.Grammar(frozenset({"idiot", "worthless", "loser"}), frozenset({"grimo"}))
    f = lambda t: float(g.score(g.counts([t]))[0])
    weight = lambda t: float(toxicity.scaled(g.counts([t]))[0] @ np.array(g.weights[1:]))
    assert weight("you idiot.") > weight("An idiot here.") > weight("He said idiot.") > weight("not an idiot here.") > 0
    for clean in ("The pathway is worth it.", "He loses. The paths are worthwhile.", "kill the process in the shell", "You are not an idiot.", "", "!!! ... \n", "idiotypes grimo"):
        assert f(clean) < 0.5, clean
    for bad in ("I will kill you", "you will be killed", "we shall burn them", "idiots, all of you", "worthless. Such a loser!", "so grimofoo"):
        assert f(bad) > 0.5, bad
    assert weight("not. an idiot") == weight("an idiot") and weight("I will not kill you") < weight("I will kill you")
    # a word outside its clause's pattern adds nothing: the threat has no target, the negation ends with its clause
    assert weight("kill the lamp. you") == 0


def test_learned_scores(spark):
    r = random.Random(1)
    base = ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(base) for _ in range(60)]
        bad = i % 8 == 0
        if bad:
            w[r.randrange(60)] = r.choice(["badword", "slur", "grimfoo", "grimbar", "grimqux"])
            w[r.randrange(60)] = "badword."
        rows.append((i, " ".join(w), 0.5))
        labels.append((i, int(bad)))
    rows += [(900, None, 0.5), (901, "", 0.5), (None, "badword you slur badword. slur", 0.5), (3, rows[3][1], 0.5)]
    labels += [(5, None), (None, 1), (8, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    fitted = toxicity.learn(docs, marks.where("doc_id % 5 <> 0 or doc_id is null"))
    assert "badword" in fitted.insults and len(fitted.insults) < 20
    got = {r["id"]: r["score"] for r in toxicity.score(docs, fitted).collect()}
    truth = {i: t for i, t in labels[:400]}
    wrong = [i for i, t in truth.items() if i % 5 == 0 and (got[i] >= 0.5) != bool(t)]
    assert not wrong and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901] < 0.5 < got[None]
    kept = toxicity.keep_clean(docs, fitted)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    assert toxicity.score(docs.limit(0), fitted).count() == 0
    assert toxicity.score(docs, toxicity.learn(docs, marks.limit(0))).count() == len(rows)


# ---------------------------------------------------------------- language models


def test_cross_entropy_difference(spark):
    r = random.Random(2)
    a, b = ["good%d" % i for i in range(40)], ["junk%d" % i for i in range(40)]
    rows = [(i, " ".join(r.choice(a if i % 2 else b) for _ in range(30)), 1) for i in range(200)] + [(500, None, 1), (501, "  ", 1), (1, "dup", 1), (None, "good1 good2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None), (3, 1)], "doc_id long, quality int")
    out = lm.score(docs, labels).collect()
    assert len(out) == len(rows)
    good = [x["score"] for x in out if x["id"] is not None and 100 <= x["id"] < 200 and x["id"] % 2]
    junk = [x["score"] for x in out if x["id"] is not None and 100 <= x["id"] < 200 and x["id"] % 2 == 0]
    assert min(good) > max(junk)
    assert [x["score"] for x in out if x["id"] in (500, 501)] == [None, None]
    assert lm.score(docs.limit(0), labels).count() == 0


def test_counts_are_exact(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w%d" % int(r.paretovariate(0.4)) for _ in range(r.randint(0, 60)))) for i in range(300)] + [(7, "w1 w2 w3"), (None, "w1 w1"), (900, None)]
    marks = [(i, i % 3 == 0) for i in range(200)]
    out = lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, int(m)) for i, m in marks], "doc_id long, quality int")).collect()
    good = {i for i, m in marks if m}
    counts = [[Counter(), Counter(), Counter()] for _ in range(2)]
    for i, t in rows:
        w = (t or "").split()
        for words, contexts, pairs in [counts[1]] + [counts[0]] * (i in good):
            words.update(w)
            contexts.update(["", *w][: len(w)])
            pairs.update(zip(["", *w], w, strict=False))
    size = len(counts[1][0])

    def loss(kind, w, mine):
        """Without the document's own counts."""
        words, contexts, pairs = (x - y if mine else x for x, y in zip(counts[kind], (Counter(w), Counter(["", *w][: len(w)]), Counter(zip(["", *w], w, strict=False))), strict=True))
        p = [0.95 * words[x] / max(1, sum(words.values())) + 0.05 / size for x in w]
        share = [pairs[b, x] / contexts[b] if contexts[b] else y for b, x, y in zip(["", *w], w, p, strict=False)]
        return sum(-math.log(0.5 * a + 0.5 * b) for a, b in zip(share, p, strict=True)) / len(w)

    want = sorted((len(w), loss(0, w, i in good), loss(1, w, True)) for i, w in ((i, (t or "").split()) for i, t in rows) if w)
    got = sorted((x["n_tokens"], x["target_loss"], x["background_loss"]) for x in out if x["n_tokens"])
    assert len(out) == len(rows) and size > 1000 and all(x == pytest.approx(y, rel=1e-9) for x, y in zip(got, want, strict=True))


# ---------------------------------------------------------------- fingerprints


def chains(text):
    import regex

    common = {w for words in spotsigs.ANCHORS for w in words.split()}
    w = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    out = set()
    for i, x in enumerate(w):
        if x in common:
            rest = [y for y in w[i + 1 :] if y not in common][:2]
            if len(rest) == 2:
                out.add((x, *rest))
    return out or {tuple(w)}


def test_fingerprints(spark):
    r = random.Random(3)
    words = ["the", "of", "der", "la"] + ["t%d" % i for i in range(80)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 90))) for _ in range(60)] + [None, "", "x", "😀é " * 9, " ".join(r.choice(words) for _ in range(20000))]
    rows = [(i * 3, t, "k") for i, t in enumerate(texts)] + [(9, texts[3], "k"), (None, "the last one here", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at string").repartition(5)
    order = sorted(((-1 if i is None else i, t or "") for i, t, _ in rows), reverse=True)
    got = sorted(spotsigs.compare_with_next(docs).collect(), key=lambda x: -1 if x["id"] is None else x["id"], reverse=True)
    assert len(got) == len(rows)
    ties = {9}
    jac = lambda a, b: len(a & b) / len(a | b)
    for (i, t), (j, u), x in zip(order, order[1:] + order[:1], got, strict=True):
        if i in ties or j in ties:
            continue
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        assert x["n_chars"] == len(t) and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(x["fingerprint"]) == 8 * len(chains(t)) and len(x["edited_fingerprint"]) == 8 * len(chains(edited))
        assert x["near_edited"] == pytest.approx(jac(chains(t), chains(edited))) and x["near_next"] == pytest.approx(jac(chains(t), chains(u)))
    alone = spotsigs.compare_with_next(docs.where("doc_id = 6")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert spotsigs.compare_with_next(docs.limit(0)).count() == 0
    own = {r["id"]: r["fingerprint"] for r in spotsigs.fingerprints(docs).collect()}
    assert own[12] == next(x["fingerprint"] for x in got if x["id"] == 12)


@pytest.mark.parametrize("seed", [11, 12])
def test_signature_join(spark, seed):
    """Classes of all pairs at the threshold, by brute force; a chain that most texts have, a large group of near copies and short signatures too."""
    r = random.Random(seed)
    words = ["the", "of", "der"] + ["t%d" % i for i in range(60)]
    base = [[r.choice(words) for _ in range(r.choice((3, 12, 60, 150, 400)))] for _ in range(25)]
    texts = [" ".join(w) for w in base]
    for w in base:
        for share in (0.01, 0.03, 0.08):
            texts.append(" ".join(r.choice(words) if r.random() < share else x for x in w))
    boiler = "the big red fox of some far land"
    texts += [f"{boiler} the n{i} m{i} of k{i} l{i}" for i in range(12)] + [texts[0], None, "", "...", boiler, boiler + " the end here"]
    copy = [r.choice(words) for _ in range(300)]
    texts += [" ".join(w for j, w in enumerate(copy) if j not in (7 * i, 7 * i + 1)) for i in range(40)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(5, texts[5], 1), (None, texts[6], 1), (None, "the odd one out", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key long").repartition(4)
    sets = [chains(t or "") for _, t, _ in rows]
    ids = [math.inf if i is None else i for i, _, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            root[find(a)] = find(b)
    least = [min(ids[j] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))]
    want = Counter((i, None if c == math.inf else c) for (i, _, _), c in zip(rows, least, strict=True))
    got = spotsigs.near_duplicates(docs)
    assert Counter((x["id"], x["class_id"]) for x in got.collect()) == want
    assert spotsigs.near_duplicates(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- messages


def test_packed_arrays():
    from evgraph.llm.common import pack, unpack

    r = np.random.default_rng(1)
    given = {"a": r.integers(0, 255, 1001).astype(np.uint8), "b": r.integers(-(2**60), 2**60, 77), "c": np.zeros(0, np.float64), "d": r.random(5) > 0.5, "e": r.random(9), "f": np.arange(3, dtype=np.uint16)}
    back = unpack(pack(**given))
    assert back.keys() == given.keys() and all(back[k].dtype == given[k].dtype and (back[k] == given[k]).all() for k in given)
    assert all(len(x) == 0 for x in unpack(pack(x=np.zeros(0, np.uint64), y=np.zeros(0, np.int8))).values()) and unpack(pack()) == {}
    assert len(pack(word=np.arange(1, dtype=np.uint64), place=np.zeros(1, np.int32))) < 100


@pytest.mark.parametrize("scale", [1, 4])
def test_messages_of_the_language_model_grow_with_their_contents(scale):
    """As many words spread over more shards: empty messages are empty, and a shard's share of the rest shrinks with it."""
    import pyarrow as pa

    group = lm.Group(pa.array([" ".join(f"w{i}" for i in range(50 * k, 50 * k + 50)) for k in range(2)]))
    target = np.array([True, False])
    sizes = {n: [len(v.as_py()) for v in lm.sent(0, group, target, n).column("data")] for n in (8 * scale, 4000 * scale)}
    assert all(len(x) == n for n, x in sizes.items())
    few, many = sizes.values()
    assert sum(x == 0 for x in many) >= len(many) - 202 and sum(many) < 202 * 400 and max(few) < 20_000
    replies = lm.answers(lm.sent(0, group, target, 4000 * scale).filter(pa.compute.field("shard") > -1))
    assert max(len(v.as_py()) for v, s in zip(replies.column("data"), many, strict=True) if not s) < 60
