"""SpotSigs fingerprints: chains of content words that follow common words.

At each anchor (a common word of its language, such as an article) a chain is formed of the next content words, those
that aren't anchors themselves. The set of all chains of a text is its signature; navigation, lists and junk have few
anchors and add little to it. A fingerprint is the sorted set as hexadecimal text, eight digits a chain.

`near_duplicates` is the join of all documents, on chains of 64 bits:

1. Equal signatures are one class. Signatures are partitioned by set length: a length class spans a factor of 1 / t, and a set meets its own class and
   the one above, so sets that can reach the threshold t always meet.
2. Within a partition an inverted index holds a signature under its rarest chains alone, by their count over all signatures: of n chains n - ceil(t n) + 1,
   for two sets that reach t must share one of these. A chain that many have is an index key only where a signature has hardly any other.
3. Jaccard is computed pair by pair for what shares a key, pruned by both lengths and by the chains left behind the shared one. A key's members are first
   compared with its least one; then only what that left apart meets the others (`operators.similarity.clusters`). So neither a chain that many share nor a
   large group of copies is a list of all pairs, and candidates aren't closed to components before they are verified.
4. Verified links are closed to classes.

`compare_with_next` compares each document with its own edit and the next document by id. For the next document, rows are dealt by ranges of ids and sorted there, and the first row of each range is dealt to the range before as well; a task
then streams its rows and holds two texts at a time. Texts are shuffled once. Rows that share one id (or have none) are one range; they are
streamed too, so that range takes one task's time but no more memory.

Whole texts count, very long ones too. A text without any chain has one for all its words, so equal texts are alike and others aren't; a null text is
empty. Documents are ordered by descending id; a null id comes last, and rows of one id go by the hash of the row. The
next document of the last one is the first. A table of one row is its own next. Repeated rows are one class. Columns other than id and text
aren't read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import GROUP_BYTES, NO_ID, keyed, lean, measure, mix, range_hashes, with_checkpoint_dir
from evgraph.llm.words import hash_word, word_hashes
from evgraph.operators.similarity import clusters

ANCHORS = (
    "a an the of and to in is was be are that it for with on as by at from this which",
    "le la les un une des de du et en est que dans pour par sur au aux",
    "der die das den dem ein eine und in zu von mit ist für auf im des",
    "el la los las un una y de del en que es por con para se al",
)
CHAIN = 2
MOST_RANGES = 4096
#: Ratio of the bounds of a length class that a fingerprint is reported with.
LENGTH_RATIO = 4.0
SLICE = 1 << 20
LAST = np.iinfo(np.int64).min


def anchors() -> np.ndarray:
    return np.unique(np.array([hash_word(w) for words in ANCHORS for w in words.split()], dtype=np.uint64))


def chains_of(texts: list[str], common: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and 64-bit hash of each chain, and for each text the hash of all its words."""
    hashes, first = word_hashes(texts)
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    anchor = common[at] == hashes
    content = np.flatnonzero(~anchor)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    spots = np.flatnonzero(anchor)
    nth = np.searchsorted(content, spots)
    ok = nth + chain <= len(content)
    spots, nth = spots[ok], nth[ok]
    ok = text[content[nth + chain - 1]] == text[spots] if len(spots) else np.zeros(0, bool)
    spots, nth = spots[ok], nth[ok]
    h = hashes[spots].copy()
    for j in range(chain):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += hashes[content[nth + j]]
    return text[spots], mix(h), range_hashes(hashes, first[:-1], first[1:])


def signature_sets(texts: list[str], common: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """Sorted 32-bit hashes of the chains of each text."""
    text, h, whole = chains_of(texts, common, chain)
    pair = np.unique((text.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)))
    bounds = np.searchsorted(pair >> np.uint64(32), np.arange(len(texts) + 1))
    chains = (pair & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    whole = (whole >> np.uint64(32)).astype(np.uint32)
    return [chains[a:b] if b > a else whole[i : i + 1] for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))]


def wide_sets(texts: list[str], common: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of the chains of each text, one text after another, and the first of each text (one more at the end)."""
    text, h, whole = chains_of(texts, common, chain)
    none = np.setdiff1d(np.arange(len(texts)), text)
    text, h = np.concatenate((text, none)), np.concatenate((h, whole[none]))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    text, h = text[new], h[new]
    return h, np.searchsorted(text, np.arange(len(texts) + 1))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sets."""
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (len(a) + len(b) - same)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def length_class(size: int) -> int:
    """Partition of a set size: from LENGTH_RATIO ** p on."""
    return int(np.log(max(1, size)) / np.log(LENGTH_RATIO) + 1e-9)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, key, class_id` of each document (key: hash of the row): the least id among documents whose signatures are linked by a
    Jaccard index of the threshold or more."""
    with_checkpoint_dir(docs.sparkSession)
    docs = keyed(docs, id_col, text_col)

    def sign(batches):
        words = anchors()
        for batch in batches:
            column = batch.column(3)
            for lo, hi in slices(column, SLICE):
                codes, first = wide_sets(column.slice(lo, hi - lo).to_pylist(), words)
                digests = [pa.array(range_hashes(codes, first[:-1], first[1:], k).view(np.int64)) for k in range(2)]
                chains = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(codes.view(np.int64)))
                yield pa.record_batch([*[batch.column(i).slice(lo, hi - lo) for i in range(3)], *digests, chains], names=["id", "no_id", "key", "d1", "d2", "chains"])

    signed = docs.select("id", "no_id", "key", "text").mapInArrow(lean(sign), "id long, no_id boolean, key long, d1 long, d2 long, chains array<long>").checkpoint()
    # the first row of each digest has the set of all of them
    sets = signed.groupBy("d1", "d2").agg(F.min("id").alias("least"), F.first("chains").alias("bits"))
    classes = sets.withColumn("n", F.size("bits")).withColumn("key", F.monotonically_increasing_id()).checkpoint()  # numbers hold once they are written
    named = classes.select("d1", "d2", "key", "least").join(clusters(classes.select("key", "bits", "n"), threshold), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    named = named.join(least, "component").select("d1", "d2", "class_id").checkpoint()
    out = signed.select("id", "no_id", "key", "d1", "d2").join(named, ["d1", "d2"])
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias("id"), "key", F.when(F.col("class_id") != int(NO_ID), F.col("class_id")).alias("class_id"))


def range_of(key: Column, splits: list[int]) -> Column:
    """Number of the range that holds a key, by a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= splits[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(splits))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, fingerprint, n_chains, length_class` of every document; nothing is shuffled."""

    def run(batches):
        common = anchors()
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                sets = signature_sets([t or "" for t in part.column(1).to_pylist()], common)
                yield pa.record_batch([part.column(0), pa.array([written(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()), pa.array([length_class(len(s)) for s in sets], pa.int32())], names=["id", "fingerprint", "n_chains", "length_class"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "id long, fingerprint string, n_chains long, length_class int")


SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, length_class int"


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of the text whose last half the next document's beginning replaces, and their likeness."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("at", F.coalesce("id", F.lit(int(LAST)))).withColumn("key", F.xxhash64("id", "text"))
    rows, size = measure(docs)
    ranges = int(np.clip(-(-size // GROUP_BYTES) * 2, 1, MOST_RANGES))
    splits = sorted({int(x) for x in docs.approxQuantile("at", [i / ranges for i in range(1, ranges)], 0.001)}) if rows and ranges > 1 else []
    docs = docs.withColumn("range", range_of(F.col("at"), splits))
    heads = docs.groupBy("range").agg(F.max(F.struct("at", "key")).alias("head")).orderBy("range").collect()  # a row for each range
    # range r holds smaller ids than r + 1; the row after r's last one is the head of the range below, or of the topmost
    own = [r["range"] for r in heads]
    before = {(r["head"]["at"], r["head"]["key"]): own[(i + 1) % len(own)] for i, r in enumerate(heads)}
    copy = F.lit(None).cast("int")
    for (at, key), target in before.items():
        copy = F.when((F.col("at") == at) & (F.col("key") == key), F.lit(target)).otherwise(copy) if len(before) <= 64 else copy
    if len(before) > 64:
        spark = docs.sparkSession
        small = spark.createDataFrame([(a, k, t) for (a, k), t in before.items()], "at long, key long, target int")  # at most MOST_RANGES rows
        docs = docs.join(F.broadcast(small), ["at", "key"], "left")
        copy = F.col("target")
    place = F.array_compact(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("late")), F.when(copy.isNotNull(), F.struct(copy.alias("range"), F.lit(1).alias("late")))))
    dealt = docs.withColumn("to", F.explode(place)).select(F.col("to.range").alias("range"), F.col("to.late").alias("late"), "at", "key", "id", "text")
    dealt = dealt.repartition(max(1, len(own)), "range").sortWithinPartitions("range", "late", F.desc("at"), F.desc("key"))

    def run(batches):
        common = anchors()
        held: list[tuple] = []  # (range, late, id, text) of the rows that wait for the next one
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part = batch.slice(lo, 100)
                held += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True)
                if len(held) > 1:
                    yield answer(held, common)
                held = held[-1:]

    def answer(held: list[tuple], common: np.ndarray) -> pa.RecordBatch:
        pairs = [(a, b) for a, b in zip(held[:-1], held[1:], strict=True) if a[0] == b[0] and not a[1]]
        texts, edited = [a[3] for a, _ in pairs], [a[3][: len(a[3]) - len(a[3]) // 2] + b[3][: len(a[3]) // 2] for a, b in pairs]
        later = signature_sets([b[3] for _, b in pairs], common)
        sets, others = [signature_sets(texts[:1], common)[0] if pairs else None, *later[:-1]] if chained(pairs) else signature_sets(texts, common), signature_sets(edited, common)
        return pa.record_batch(
            [
                pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([written(s) for s in sets[: len(pairs)]], pa.string()), pa.array([written(s) for s in others], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(sets, others, strict=False)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(sets, later, strict=False)], pa.float64()),
                pa.array([length_class(len(s)) for s in sets[: len(pairs)]], pa.int32()),
            ],
            names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "length_class"],
        )

    def chained(pairs: list) -> bool:
        """Whether each pair's second document is the next pair's first one."""
        return bool(pairs) and all(x[1] is y[0] for x, y in zip(pairs[:-1], pairs[1:], strict=True))

    return dealt.mapInArrow(lean(run), SCHEMA)
