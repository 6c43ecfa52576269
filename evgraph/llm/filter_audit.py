"""Filter interaction audit by recursive enumeration: what each quality filter removes, in every order of the filters.

1. Each document gets a mask with a bit for each filter that it fails; whether its text stands under a smaller id is found on
   counts by digest of the text, so copies are collapsed in their tasks before anything is shuffled.
2. Documents become cells (part, mask) with counts, at most 32 for a part.
3. A recursive query extends prefixes of filters by a letter not yet used, joined with the masks, and carries the bits already
   applied: 325 prefixes and 32 masks, whatever the input. Each level tells for its last filter which masks are removed there.
4. Prefixes meet the cells on the mask, and each of the 120 orders takes the figures of its five prefixes.

Filters, on whole texts: A under 200 words; B 100 x distinct words < 50 x words; C 100 x [A-Z] > 3 x code points; D any of
`#$%&*|`; E the text also stands under a smaller id. Words are runs of other characters than blank and \\t\\n\\v\\f\\r, case kept.

A null text is empty: it fails A (and E, where an empty text has a smaller id). A null id is larger than any and has no labels;
rows that tie as the smallest id of a text all pass E. A null part is the empty string. A document is good or toxic if any row of
labels with its id says so; labels of null ids count nowhere. Rows that repeat count each. Other columns aren't read. Without
documents there are no parts and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.llm.common import with_checkpoint_dir

FILTERS = 5
WORD, CAPITALS, MARKS = r"[^\x20\x09-\x0D]+", "[^A-Z]+", "[#$%&*|]"

ENUMERATE = """
WITH RECURSIVE letters AS (SELECT * FROM VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16) AS t(letter, bit)),
walk(prefix, step, letter, bit, applied, mask) AS (
  SELECT '', 0, '', 0, 0, CAST(id AS INT) FROM range(32)
  UNION ALL
  SELECT concat(w.prefix, l.letter), w.step + 1, l.letter, l.bit, w.applied | l.bit, w.mask FROM walk w JOIN letters l ON w.applied & l.bit = 0
)
SELECT prefix, step, letter, mask,
  mask & applied = 0 AS kept,
  mask & bit <> 0 AND mask & (applied ^ bit) = 0 AS removed,
  mask & bit <> 0 AND mask & (applied ^ bit) <> 0 AS redundant,
  mask = bit AS only_this
FROM walk WHERE step > 0
"""


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """no_id, key (the id; for a null id a hash of the text, so that these rows are spread), part, digest, mask of A to D."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    own = own.select("id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    own = own.select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.size("words").alias("n"), F.size(F.array_distinct("words")).alias("different"), F.length("text").alias("points"),
        F.length(F.regexp_replace("text", CAPITALS, "")).alias("capitals"), F.col("text").rlike(MARKS).alias("marks"),
    )
    c = lambda x: F.col(x).cast("long")
    tests = [c("n") < 200, 100 * c("different") < 50 * c("n"), 100 * c("capitals") > 3 * c("points"), F.col("marks")]
    mask = sum((t.cast("int") * (1 << i) for i, t in enumerate(tests)), F.lit(0))
    return own.select(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.xxhash64("digest")).alias("key"), "part", "digest", mask.alias("mask"))


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (of all five), n, good, toxic: documents of each kind."""
    with_checkpoint_dir(failed.sparkSession)
    # written first, so that both sides of the join are plain exchanges and a hot id can be split
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).withColumn("no_id", F.lit(False)).checkpoint()
    each = failed.groupBy("no_id", "key", "part", "digest", "mask").agg(F.count("*").alias("n"))
    each = each.join(said, ["no_id", "key"], "left").na.fill(False, ["good", "toxic"])
    rank = F.struct("no_id", F.when(~F.col("no_id"), F.col("key")).alias("key"))
    groups = each.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct(rank.alias("rank"), F.col("n").alias("n"))).alias("first"))
    groups = groups.withColumn("least", F.min("first.rank").over(W.partitionBy("digest")))
    passing = F.when(F.col("first.rank") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), passing.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - passing).alias("n")))
    rows = groups.select("part", "good", "toxic", F.explode(split).alias("x")).where("x.n > 0")
    return rows.groupBy("part", F.col("x.mask").alias("mask")).agg(F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows for each part."""
    spark = docs.sparkSession
    found = cells(failures(docs, **columns), labels).checkpoint()
    of = lambda flag, what="n": F.sum(F.when(F.col(flag), F.col(what)).otherwise(0))
    walk = spark.sql(ENUMERATE)
    steps = walk.join(found, "mask").groupBy("part", "prefix", "step", "letter").agg(
        of("kept").alias("kept"), of("removed").alias("removed"), of("redundant").alias("redundant"), of("only_this").alias("unique_fails"), of("removed", "good").alias("good_lost"), of("removed", "toxic").alias("toxic_lost"))
    orders = walk.where(f"step = {FILTERS}").select(F.col("prefix").alias("filter_order")).distinct()
    orders = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(FILTERS))).alias("k")).select("filter_order", F.expr("substring(filter_order, 1, k)").alias("prefix"))
    out = steps.join(orders, "prefix").withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "letter")))
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
