"""Licence scan: ordered signature rules over words, with functions of Spark SQL alone.

1. Keyword prefilter: which of the rules' keywords are among a text's words, by one hash lookup for each word. Only texts with a keyword go on, and of
   the rules only those whose keywords are all there.
2. Such a text is written as words (letters and digits, A-Z lowered, other characters separate), each between two blanks, so that patterns
   begin and end at words and what lies between two matches is whole words too.
3. A rule's places: the words between its matches and in them, summed up in the order of the text.
4. Detections of a text are sorted by place. One is suppressed by another that contains its interval and is of a stronger tier, of the same tier and
   longer, or, for equal intervals of a tier, of an earlier rule. As containers come first in the order, a running maximum of ends for
   each tier tells it: linear in the detections, whatever a text holds.
5. Base phrases have fixed labels, which no rule suppresses; all places count.

`scan` gives a row for each document: id, n_words, n_base (places of base phrases), first_word, last_word (their least and greatest start; null
without any), base_labels, labels (of base phrases and detections that stand; sorted, joined by commas, else empty), n_detections, score (of the
surest detection that stands, MENTION for base phrases alone, else 0). `detections` gives those that stand as rows.

A null text is empty: no words, no labels, score 0. A null id stays null. Rows that repeat get equal rows each. Long texts are
scanned whole by linear patterns. Other columns aren't read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.llm.common import with_checkpoint_dir
from evgraph.llm.license_rules import CONFIDENCE, Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD, BETWEEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Score of a text that has base phrases and nothing surer.
MENTION = 0.5


def spaced(pattern: str) -> str:
    """A pattern of words as one of words between two blanks each."""
    return f" (?:{pattern.replace(' ', '  ')}) " if "|" in pattern else f" {pattern.replace(' ', '  ')} "


def in_words(text: Column) -> Column:
    """' licensed  under  the  mit  license ', or nothing for a text without words."""
    words = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def count_words(part: Column) -> Column:
    """Each word has two blanks around it (a half of them can be cut off at an end)."""
    return F.floor((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) + 1) / 2).cast("long")


def matches(words: Column, rule: Column) -> Column:
    """(gap, size) of each place of a rule: words before it since the last one, words in it."""
    found, around = F.regexp_extract_all(words, rule["pattern"], F.lit(0)), F.split(words, rule["pattern"], -1)
    both = F.zip_with(found, around, lambda x, y: F.struct(count_words(y).alias("gap"), count_words(x).alias("size")))
    return F.filter(both, lambda x: x["size"].isNotNull())


def detect(docs: DataFrame, ordered: list[Rule], id_col: str, text_col: str) -> DataFrame:
    """id, text_key, the base columns, and places: the raw (number, place, gap, size) of all rules that match."""
    table = F.array(*[F.struct(F.lit(r.number).alias("number"), F.array(*map(F.lit, r.keywords)).alias("keywords"), F.lit(spaced(r.pattern)).alias("pattern")) for r in ordered])
    keywords = F.array(*[F.lit(k) for k in sorted({k for r in ordered for k in r.keywords} | {p.split(" ")[0] for p in BASE})])
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    # lower() lowers other letters too, but none of them is left out of a word or becomes a keyword
    own = own.withColumn("each", F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0)))
    own = own.select("id", "text_key", "text", F.size("each").cast("long").alias("n_words"), F.array_intersect("each", keywords).alias("held"))
    own = own.select("id", "text_key", "n_words", "held", F.when(F.size("held") > 0, in_words(F.col("text"))).otherwise("").alias("w"))
    base = F.when(F.col("w") == "", F.array(F.lit(""))).otherwise(F.split("w", " (?=(?:%s) )" % "|".join(p.replace(" ", "  ") for p in BASE), -1))
    own = own.select("*", base.alias("base"))
    active = F.filter(table, lambda r: F.size(F.array_except(r["keywords"], F.col("held"))) == 0)
    places = F.flatten(F.transform(active, lambda r: F.transform(matches(F.col("w"), r), lambda x, i: F.struct(r["number"].alias("number"), i.alias("place"), x["gap"].alias("gap"), x["size"].alias("size")))))
    n = F.size("base") - 1
    labels = F.array_sort(F.array_compact(F.array(*[F.when(F.contains(F.col("w"), F.lit(spaced(p))), label) for p, label in BASE.items()])))
    return own.select(
        "id", "text_key", "n_words", n.cast("long").alias("n_base"), F.when(n > 0, count_words(F.element_at("base", 1))).alias("first_word"),
        F.when(n > 0, F.col("n_words") - count_words(F.element_at("base", -1))).alias("last_word"), F.when(n > 0, labels).otherwise(F.array().cast("array<string>")).alias("base_labels"),
        F.when(F.col("w") != "", places).alias("places"),
    )


def standing(found: DataFrame, ordered: list[Rule]) -> DataFrame:
    """id, text_key, number, tier, start, end of the detections that none suppresses. Copies of a row are one."""
    each = found.where(F.size("places") > 0).select("id", "text_key", "n_words", F.explode("places").alias("p")).select("id", "text_key", "n_words", "p.*").distinct()
    tiers = {t: [r.number for r in ordered if r.tier == t] for t in CONFIDENCE}
    each = each.withColumn("tier", reduce(lambda c, t: c.when(F.col("number") <= max(tiers[t]), t), [t for t in tiers if tiers[t]], F))
    text = ["id", "text_key", "n_words"]
    so_far = W.partitionBy(*text, "number").orderBy("place")
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far.rowsBetween(W.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("size"))
    before = W.partitionBy(*text).orderBy("start", F.desc("end"), "tier", "number").rowsBetween(W.unboundedPreceding, -1)
    reach = F.coalesce(*[F.when(F.col("tier") == t, F.max(F.when(F.col("tier") <= t, F.col("end"))).over(before)) for t in CONFIDENCE], F.lit(-1))
    return each.withColumn("reach", reach).where("reach < end").select(*text, "number", "tier", "start", "end")


def names(ordered: list[Rule]) -> Column:
    return F.element_at(F.array(*[F.lit(r.label) for r in ordered]), F.col("number") + 1)


def sureness() -> Column:
    return F.element_at(F.create_map(*[x for t, c in CONFIDENCE.items() for x in (F.lit(t), F.lit(c))]), F.col("tier"))


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, label, tier, start, end (words from 0, end excluded) of each detection that stands; copies of a row give one set."""
    ordered = rules()
    stands = standing(detect(docs, ordered, id_col, text_col), ordered)
    return stands.select("id", names(ordered).alias("label"), "tier", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, n_detections, score of each document."""
    with_checkpoint_dir(docs.sparkSession)
    ordered = rules()
    found = detect(docs, ordered, id_col, text_col).checkpoint()  # without texts; both sides of the join below are then plain exchanges
    text = ["id", "text_key", "n_words"]
    each = standing(found, ordered).groupBy(*text).agg(F.collect_set(names(ordered)).alias("own"), F.count("*").alias("n_detections"), F.max(sureness()).alias("sure")).checkpoint()
    same = reduce(lambda a, b: a & b, [found[c].eqNullSafe(each[c]) for c in text])
    out = found.join(each, same, "left").select(found["*"], "own", "n_detections", "sure")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.coalesce(F.col("sure"), F.when(F.col("n_base") > 0, F.lit(MENTION)).otherwise(F.lit(0.0)))
    return out.select(
        "id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_distinct("base_labels"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.coalesce("n_detections", F.lit(0).cast("long")).alias("n_detections"), score.alias("score"),
    )
