"""Common neighbours: which nodes share hubs, how many, and how many pairs there are.

A hub with n neighbours makes n (n - 1) / 2 pairs, so what is shuffled for a pair is kept small, and large hubs make none:

- Nodes get numbers. Pairs travel as lists: a node's number with those of the others at a hub, dealt by the node. Its task counts them, so no pair is
  ever shuffled, and a pair costs some bytes.
- Counting all pairs, hubs of more than `block` neighbours are set apart. Nodes with the same set of these are one class with a size, and pairs are counted for two classes
  at once; what small hubs add to them is moved from one count to another. Sets are told apart by their size and two 64-bit hashes that add up in the tasks, so no set is ever gathered.
- Where pairs must share `at_least` hubs, each node's hubs are ordered by degree and only the rarest are tried: a pair with m in
  common shares k of the first n - m + k of each, for any k. The largest hubs then make no pairs; what is found is counted over all hubs.
- A hub's neighbours are split by hash into lists of about `block`, each a key of its own in the join.

Edges have no direction here; parallel ones count once, self-loops and rows with a null end are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.components import ensure_checkpoint_dir


def adjacency(edges: DataFrame, hub_labels: list[str] | None = None, without: list[str] = ()) -> DataFrame:
    """a, hub: each node with each of its neighbours, once. With `hub_labels` only neighbours of these labels count, and none of
    those in `without` (context labels, which tell nothing of their neighbours); labels need from_label and to_label. Written, as all that follows
    reads it several times."""
    ensure_checkpoint_dir(edges.sparkSession)
    labels = [F.col(c) if c in edges.columns else F.lit(None).cast("string") for c in ("from_label", "to_label")]
    out = edges.select(F.col("_from").alias("a"), F.col("_to").alias("hub"), labels[1].alias("l")).unionByName(edges.select(F.col("_to").alias("a"), F.col("_from").alias("hub"), labels[0].alias("l")))
    out = out.where("a <> hub")
    if hub_labels is not None:
        out = out.where(F.col("l").isin(*hub_labels))
    if without:
        out = out.where(F.col("l").isNull() | ~F.col("l").isin(*without))
    return out.select("a", "hub").distinct().checkpoint()


def with_degrees(near: DataFrame) -> DataFrame:
    """Adds how many nodes the hub has. Written first, so that a hub with a large share of all rows can be split in the join."""
    ensure_checkpoint_dir(near.sparkSession)
    return near.join(near.groupBy("hub").agg(F.count("*").alias("degree")).checkpoint(), "hub")


#: Pairs that one task counts, on average.
TASK_PAIRS = 2_000_000
#: Groups that are numbered one by one, and the bits below a class's number (numbers of up to 68 thousand million nodes and 67 million classes).
GROUPS, NODE_BITS = 4096, 36


def number(*key: str) -> Column:
    """Small numbers, each once, of different keys."""
    group = F.pmod(F.xxhash64(*key), F.lit(GROUPS))
    return F.row_number().over(W.partitionBy(group).orderBy(*key)).cast("long") * GROUPS + group


def numbered(near: DataFrame) -> DataFrame:
    """name, a: a number for each node."""
    ensure_checkpoint_dir(near.sparkSession)
    return near.select(F.col("a").alias("name")).distinct().withColumn("a", number("name")).checkpoint()


def with_numbers(near: DataFrame, numbers: DataFrame) -> DataFrame:
    return near.withColumnRenamed("a", "name").join(numbers, "name").drop("name")


def companions(rows: DataFrame, block: int) -> DataFrame:
    """a, bs: a row for each node, each hub and each list of its other nodes b, a < b. rows: a, hub, degree."""
    parts = F.ceil(F.col("degree") / block).cast("int")
    lists = rows.groupBy("hub", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part")).agg(F.sort_array(F.collect_list("a")).alias("bs"))
    met = rows.select("hub", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "a").join(lists, ["hub", "part"])
    return met.select("a", F.filter("bs", lambda b: b > F.col("a")).alias("bs")).where(F.size("bs") > 0)


def wedges(rows: DataFrame, block: int) -> DataFrame:
    """a, b: a row for each two nodes and each hub between them, a < b. rows: a, hub, degree."""
    return companions(rows, block).select("a", F.explode("bs").alias("b"))


def made(rows: DataFrame) -> int:
    """How many wedges there are: one number to the driver."""
    n = F.count("*")
    return int(rows.groupBy("hub").agg((n * (n - 1) / 2).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0])


def counted(rows: DataFrame, block: int, wedges: int) -> DataFrame:
    """a, b, n_common, a < b, where a hub is shared; each node's lists meet in one task. wedges: how many are `made`."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), wedges // TASK_PAIRS)
    return companions(rows, block).repartition(tasks, "a").select("a", F.explode("bs").alias("b")).groupBy("a", "b").agg(F.count("*").alias("n_common"))


def placed(near: DataFrame, at_least: int) -> DataFrame:
    """near with degrees and place among its node's n hubs, rare ones first, for nodes with so many hubs."""
    of = W.partitionBy("a")
    return with_degrees(near).withColumn("place", F.row_number().over(of.orderBy("degree", "hub"))).withColumn("n", F.count("*").over(of)).where(F.col("n") >= at_least)


def rare(at_least: int, sure: int) -> Column:
    return F.col("place") <= F.col("n") - at_least + sure


def rarest_hubs(near: DataFrame, at_least: int, sure: int = 1) -> DataFrame:
    """near with degrees, without the hubs that a pair with `at_least` in common needn't be looked for in: it shares `sure` of those left."""
    return placed(near, at_least).where(rare(at_least, sure)).select("a", "hub", "degree")


def common_neighbours(near: DataFrame, at_least: int = 1, block: int = 1000, most_sure: int = 3) -> DataFrame:
    """a, b, n_common: pairs of nodes (a < b) that share at least so many hubs; near: `adjacency`. What is found by more than one rare hub is less often false, so
    up to `most_sure` are asked for where this makes few more wedges."""
    numbers = numbered(near)
    rows = placed(with_numbers(near, numbers), at_least).checkpoint()
    kept = [rows.where(rare(at_least, k)) for k in range(1, min(most_sure, at_least) + 1)]
    work = [made(x) for x in kept]
    sure = max(k for k, n in enumerate(work, 1) if n <= 4 * work[0])
    found = counted(kept[sure - 1], block, work[sure - 1]).where(F.col("n_common") >= sure)
    if sure < at_least:
        hubs = rows.select("a", "hub")
        found = found.select("a", "b").join(hubs, "a").join(hubs.withColumnRenamed("a", "b"), ["b", "hub"]).groupBy("a", "b").agg(F.count("*").alias("n_common")).where(F.col("n_common") >= at_least)
    name = lambda c, to: numbers.select(F.col("a").alias(c), F.col("name").alias(to))
    return found.join(name("a", "u"), "a").join(name("b", "v"), "b").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "n_common")


def hub_classes(near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """c (a number), first (the least node), size, n_hubs of each class of nodes with the same hubs; and a, c of each node."""
    of = near.groupBy("a").agg(F.count("*").alias("n_hubs"), F.bit_xor(F.xxhash64("hub")).alias("h1"), F.bit_xor(F.xxhash64(F.lit("other"), "hub")).alias("h2"))
    same = ["n_hubs", "h1", "h2"]
    classes = of.groupBy(*same).agg(F.min("a").alias("first"), F.count("*").alias("size")).withColumn("c", number(*same)).checkpoint()
    return classes.select("c", "first", "size", "n_hubs"), of.join(classes, same).select("a", "c")


def class_pairs(near: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """c, d, n_common, pairs of each two classes (c < d) that share hubs, and of each class with itself."""
    side = lambda c, first: classes.select(F.col("first").alias(first), F.col("c").alias(c), F.col("size").alias(f"n_{c}"))
    firsts = near.join(classes.select(F.col("first").alias("a")), "a", "left_semi").checkpoint()
    between = common_neighbours(firsts, block=block).join(side("p", "a"), "a").join(side("q", "b"), "b")
    between = between.select(F.least("p", "q").alias("c"), F.greatest("p", "q").alias("d"), "n_common", (F.col("n_p") * F.col("n_q")).alias("pairs"))
    return between.unionByName(classes.select("c", F.col("c").alias("d"), F.col("n_hubs").alias("n_common"), F.expr("size * (size - 1) div 2").alias("pairs")))


def pair_counts(near: DataFrame, block: int = 1000) -> DataFrame:
    """n_common, pairs: how many pairs of nodes share so many hubs, exactly and for every number that occurs."""
    rows = with_degrees(near).checkpoint()
    numbers, large, small = numbered(near), rows.where(F.col("degree") > block).select("a", "hub"), rows.where(F.col("degree") <= block)
    wedges = made(small)
    if large.isEmpty():
        return counted(with_numbers(small, numbers), block, wedges).groupBy("n_common").agg(F.count("*").alias("pairs"))
    classes, of = hub_classes(large)
    with_class = of.withColumnRenamed("a", "name").join(numbers, "name", "right").select("name", (F.shiftleft(F.coalesce("c", F.lit(0).cast("long")), NODE_BITS) + F.col("a")).alias("a"))  # no class has number 0
    of_class = lambda c: F.shiftright(c, NODE_BITS)
    found = counted(with_numbers(small, with_class), block, wedges)  # a < b, so classes are in order, too
    through_small = found.groupBy(of_class("a").alias("c"), of_class("b").alias("d"), F.col("n_common").alias("n")).agg(F.count("*").alias("pairs")).checkpoint()
    through_large = class_pairs(large, classes, block).checkpoint()
    both = through_small.join(through_large.select("c", "d", "n_common"), ["c", "d"], "left")
    more = both.select((F.col("n") + F.coalesce("n_common", F.lit(0))).alias("n_common"), "pairs")
    moved = both.where("n_common is not null").select("n_common", (-F.col("pairs")).alias("pairs"))
    out = through_large.select("n_common", "pairs").unionByName(more).unionByName(moved)
    return out.groupBy("n_common").agg(F.sum("pairs").alias("pairs")).where("pairs > 0")


def shared_pairs(near: DataFrame, block: int = 1000) -> DataFrame:
    """pairs, incidences: different pairs of nodes that share a hub, and pairs counted for each hub they share. One row."""
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return pair_counts(near, block).agg(zero(F.sum("pairs")).alias("pairs"), zero(F.sum(F.col("pairs") * F.col("n_common"))).alias("incidences"))


def top_common(near: DataFrame, k: int, block: int = 1000) -> DataFrame:
    """a, b, n_common of the k pairs with most hubs in common, ties to the lesser a, then b. The counts of all pairs tell how many a pair must
    share to be among the k; only such pairs are made."""
    counts = pair_counts(near, block)
    enough = counts.withColumn("so_far", F.sum("pairs").over(W.orderBy(F.desc("n_common")))).where(F.col("so_far") >= k)  # a row for each number of shared hubs
    least = enough.agg(F.coalesce(F.max("n_common"), F.lit(1))).first()[0]
    return common_neighbours(near, least, block).orderBy(F.desc("n_common"), "a", "b").limit(k)
