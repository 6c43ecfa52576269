"""Tanimoto similarity join of fingerprints: sparse bit vectors as lists of the bits that are set.

1. Equal fingerprints are one class; copies never meet as pairs.
2. Bits are ordered by how many classes have them. Two sets that reach the threshold t share one of the first n - ceil(t n) + 1 bits of each, so only
   these rare bits are indexed, with their place.
3. Index rows are partitioned by bit and by length class (powers of 1 / t): a set meets its own class and the one above, no others.
   Of what meets, sizes, the bits left behind each place and signatures of 128 bits bound the overlap from above.
4. What can still reach t is verified where it meets, on the whole vectors, which travel with the index. A pair is told at the first bit that it shares and
   nowhere else, so pairs that only may reach the threshold are neither written nor shuffled nor made distinct.
5. An entry (bit, length class) of many rows is dealt to blocks, and each row that looks for partners is sent to all of them: a task's work is bounded, and
   the work of one bit can be shared by as many tasks as it needs.

Bits are any whole numbers; null bits and repeated ones don't count. A fingerprint that is null or has no bits is left out of the pairs and is a
member of no class (null class_id). A null id counts like any other value; the class's id is the least that isn't null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.components import connected_components, ensure_checkpoint_dir

EDGE = 1e-9


def reaches(shared: Column, n: Column, m: Column, threshold: float) -> Column:
    return shared >= threshold * (n + m - shared) - EDGE


def length_class(n: Column, threshold: float) -> Column:
    """Two sizes that can reach the threshold are of one class or of neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(1 / threshold) + EDGE)


def index(classes: DataFrame, threshold: float) -> DataFrame:
    """bit, p (length class), key, n, place of the bits that a pair of classes (key, bits, n) must share one of, the class's bits in the order of their use
    (ordered) and its other columns."""
    each = classes.select("key", F.explode("bits").alias("bit"))
    common = each.groupBy("bit").agg(F.count("*").alias("used")).checkpoint()
    ordered = each.join(common, "bit").groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("used", "bit"))), lambda x: x["bit"]).alias("ordered"))
    rest = [c for c in classes.columns if c not in ("key", "bits", "n")]
    first = F.slice("ordered", F.lit(1), (F.col("n") - F.ceil(threshold * F.col("n") - EDGE) + 1).cast("int"))
    rows = ordered.join(classes.select("key", "n", *rest), "key").select("key", "n", "ordered", *rest, F.posexplode(first).alias("i", "bit"))
    return rows.select("bit", length_class(F.col("n"), threshold).alias("p"), "key", "n", (F.col("i") + 1).alias("place"), "ordered", *rest)


def may_reach(threshold: float) -> Column:
    """Whether what meets at places i and j can still reach the threshold, by both sizes and the bits that are left behind these places."""
    c = F.col
    most = 1 + F.least(c("n_x") - c("i"), c("n_y") - c("j"))
    return (F.least("n_x", "n_y") >= threshold * F.greatest("n_x", "n_y") - EDGE) & reaches(most, c("n_x"), c("n_y"), threshold)


#: Rows of an index entry that a block holds, about.
BLOCK = 4096


def signed(rows: DataFrame) -> DataFrame:
    """Adds a signature of 128 bits (low, high) of `ordered` and how many of its bits fell on one that was set already (spare)."""
    places = F.transform("ordered", lambda b: F.pmod(F.xxhash64(b), F.lit(128)).cast("int"))
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h)
    union = lambda hs: F.aggregate(hs, F.lit(0).cast("long"), lambda a, h: a.bitwiseOR(one(h)))
    rows = rows.withColumn("_h", places)
    rows = rows.withColumns({"low": union(F.filter("_h", lambda h: h < 64)), "high": union(F.transform(F.filter("_h", lambda h: h >= 64), lambda h: h - 64))}).drop("_h")
    return rows.withColumn("spare", F.col("n") - F.bit_count("low") - F.bit_count("high"))


def meetings(classes: DataFrame, threshold: float) -> DataFrame:
    """x, y, bit, n_x, n_y, ordered_x, ordered_y and the classes' other columns as <name>_x and <name>_y of what meets in the index and may reach the threshold; a pair
    comes once for each indexed bit that it shares."""
    rows = signed(index(classes, threshold)).checkpoint()
    names = ["n", "ordered", *[c for c in classes.columns if c not in ("key", "bits", "n")]]
    blocks = rows.groupBy("bit", "p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).checkpoint()
    side = lambda c, key, place: [F.col("key").alias(key), F.col("place").alias(place), *[F.col(x).alias(f"{x}_{c}") for x in ("low", "high", "spare", *names)]]
    left = rows.select(F.explode(F.array(F.col("p"), F.col("p") + 1)).alias("p"), F.col("p").alias("p_x"), "bit", *side("x", "x", "i")).join(blocks, ["bit", "p"])
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = rows.join(blocks, ["bit", "p"]).select("bit", "p", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), *side("y", "y", "j"))
    c = F.col
    once = (c("p_x") < c("p")) | (c("x") < c("y"))
    signature = F.bit_count(c("low_x").bitwiseAND(c("low_y"))) + F.bit_count(c("high_x").bitwiseAND(c("high_y"))) + F.least("spare_x", "spare_y")
    both = left.join(right, ["bit", "p", "block"]).where(once & may_reach(threshold) & reaches(signature, c("n_x"), c("n_y"), threshold))
    return both.select("x", "y", "bit", *[f"{x}_{s}" for x in names for s in ("x", "y")])


def candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """x, y: keys of classes that may reach the threshold, each pair once."""
    return meetings(classes.select("key", "bits", "n"), threshold).select("x", "y").distinct()


def met(classes: DataFrame, threshold: float) -> DataFrame:
    """x, y, shared, union of all pairs of classes (key, bits, n) that reach the threshold, each once, with the classes' other columns as <name>_x and <name>_y."""
    # verified above the join, not in its condition: with the set functions inlined the generated loop is too long to be compiled, and the join runs interpreted
    same = F.explode(F.transform(F.array(F.lit(0)), lambda _: F.array_intersect("ordered_x", "ordered_y"))).alias("same")
    rest = [f"{x}_{s}" for x in classes.columns if x not in ("key", "bits", "n") for s in ("x", "y")]
    both = meetings(classes, threshold).select("x", "y", "bit", "n_x", "n_y", *rest, same).withColumn("shared", F.size("same"))
    both = both.where((F.get("same", F.lit(0)) == F.col("bit")) & reaches(F.col("shared"), F.col("n_x"), F.col("n_y"), threshold))
    return both.select("x", "y", "shared", (F.col("n_x") + F.col("n_y") - F.col("shared")).alias("union"), *rest)


def verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """x, y, shared, union of the pairs (x, y) that reach the threshold, compared on the whole vectors."""
    side = lambda c: classes.select(F.col("key").alias(c), F.col("bits").alias(f"bits_{c}"), F.col("n").alias(f"n_{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").withColumn("shared", F.size(F.array_intersect("bits_x", "bits_y")))
    return both.where(reaches(F.col("shared"), F.col("n_x"), F.col("n_y"), threshold)).select("x", "y", "shared", (F.col("n_x") + F.col("n_y") - F.col("shared")).alias("union"))


def checked(threshold: float) -> float:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    return threshold


def similar(classes: DataFrame, threshold: float) -> DataFrame:
    """x, y, shared, union of all pairs of classes (key, bits without repetition, n; written, as they are read often) at the threshold, above 0 and at most 1;
    other columns of the classes follow as <name>_x and <name>_y."""
    if checked(threshold) == 1:  # equal sets are a class already
        rest = [F.col(c).alias(f"{c}_{s}") for c in classes.columns if c not in ("key", "bits", "n") for s in ("x", "y")]
        return classes.limit(0).select(F.col("key").alias("x"), F.col("key").alias("y"), F.col("n").alias("shared"), F.col("n").alias("union"), *rest)
    return met(classes, threshold)


def clusters(classes: DataFrame, threshold: float) -> DataFrame:
    """key, component of all classes that a chain of pairs at the threshold joins with another one: what `similar` and the components of its pairs
    give, without comparing what is joined already. What shares an index entry is first compared with its least member only; then what that left apart from
    the entry's largest component is compared with the entry's other members. So a group of near copies makes no pairs beyond a few for each member."""
    if checked(threshold) == 1:
        return classes.limit(0).select("key", F.col("key").alias("component"))
    rows = index(classes, threshold).select("bit", F.explode(F.array(F.col("p"), F.col("p") + 1)).alias("q"), "p", "key", "n", "place").checkpoint()
    entry, own = ["bit", "q"], F.col("p") == F.col("q")  # members of the length class below meet those of the entry's own, not each other
    name = lambda c, i: [F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("place").alias(i)]
    hubs = rows.where(own).groupBy(*entry).agg(F.min(F.struct("key", "n", "place")).alias("hub")).select(*entry, F.col("hub.key").alias("y"), F.col("hub.n").alias("n_y"), F.col("hub.place").alias("j")).checkpoint()
    stars = rows.select(*entry, *name("x", "i")).join(hubs, entry).where((F.col("x") != F.col("y")) & may_reach(threshold)).select("x", "y").distinct()
    first = verified(stars, classes, threshold).select("x", "y").checkpoint()
    joined = connected_components(first, "x", "y").withColumnRenamed("node", "key").checkpoint()
    members = rows.join(joined, "key", "left").withColumn("component", F.coalesce("component", "key")).checkpoint()
    main = members.groupBy(*entry, "component").agg(F.count("*").alias("m")).groupBy(*entry).agg(F.max(F.struct("m", "component")).alias("main")).select(*entry, F.col("main.component").alias("main")).checkpoint()
    told = members.join(main, entry)
    apart = told.where("component <> main").select(*entry, *name("x", "i"), F.col("component").alias("c_x"), own.alias("own_x"))
    others = told.select(*entry, *name("y", "j"), F.col("component").alias("c_y"), own.alias("own_y"), (F.col("component") == F.col("main")).alias("held"))
    once = F.col("held") | (F.col("x") < F.col("y"))
    rest = apart.join(others, entry).where((F.col("c_x") != F.col("c_y")) & (F.col("own_x") | F.col("own_y")) & once & may_reach(threshold)).select("x", "y").distinct()
    links = first.unionByName(verified(rest, classes, threshold).select("x", "y"))
    return connected_components(links, "x", "y").withColumnRenamed("node", "key")


class Fingerprints:
    """The classes of equal fingerprints of a table."""

    def __init__(self, rows: DataFrame, id_col: str = "id", bits_col: str = "bits"):
        ensure_checkpoint_dir(rows.sparkSession)
        bits = F.array_sort(F.array_distinct(F.array_compact(F.col(bits_col))))
        self.rows = rows.select(F.col(id_col).alias("id"), F.when(F.size(bits) > 0, bits).alias("bits"))
        classes = self.rows.where("bits is not null").groupBy("bits").agg(F.min("id").alias("class_id"), F.count("*").alias("size"))
        self.classes = classes.withColumn("n", F.size("bits")).withColumn("key", F.monotonically_increasing_id()).checkpoint()  # numbers hold once they are written


def ratio() -> Column:
    return F.round(F.col("shared") / F.col("union"), 6)


def similar_classes(found: Fingerprints, threshold: float) -> DataFrame:
    """a, b, similarity: pairs of class ids (a < b); with `members` this tells every pair of rows."""
    out = similar(found.classes.select("key", "bits", "n", "class_id"), threshold)
    return out.select(F.least("class_id_x", "class_id_y").alias("a"), F.greatest("class_id_x", "class_id_y").alias("b"), ratio().alias("similarity"))


def members(found: Fingerprints, threshold: float) -> DataFrame:
    """id, class_id, n_bits, n_similar (other rows at the threshold or above, equal ones included), best (highest similarity to another row,
    null if none reaches the threshold) of each row. Pairs are summed up by the tasks that meet them; only the sums are shuffled."""
    pairs = similar(found.classes.select("key", "bits", "n", "size"), threshold)
    end = lambda key, others: F.struct(F.col(key).alias("key"), F.col(others).alias("others"), ratio().alias("s"))
    ends = pairs.select(F.explode(F.array(end("x", "size_y"), end("y", "size_x"))).alias("e")).select("e.*")
    near = ends.groupBy("key").agg(F.sum("others").alias("others"), F.max("s").alias("s"))
    each = found.classes.join(near, "key", "left")
    n_similar = F.col("size") - 1 + F.coalesce("others", F.lit(0))
    each = each.select("bits", "class_id", F.col("n").alias("n_bits"), n_similar.alias("n_similar"), F.when(F.col("size") > 1, F.lit(1.0)).otherwise(F.col("s")).alias("best")).checkpoint()
    out = found.rows.join(each, "bits", "left")
    return out.select("id", "class_id", F.coalesce("n_bits", F.lit(0)).alias("n_bits"), F.coalesce("n_similar", F.lit(0).cast("long")).alias("n_similar"), "best")
