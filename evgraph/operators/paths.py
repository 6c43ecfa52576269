"""Best paths: the product of edge strengths along a path, divided by its number of edges.

A traversal by levels whose state is (hops, product) for each start and node. Of equal hops only the largest product is kept. A state is dominated, and
goes no further, if the node was reached in fewer hops with a product that is no less: strengths are at most 1, so whatever follows from it scores no more.
That also ends every cycle. With `least`, states that can't reach that score any more end too.

The states of a node travel along its edges as one list, for all starts of a group, and meet what is known of their pairs at the next node: a level is one shuffle of
lists. Nothing of a level is written but that shuffle, which the levels after it and the last aggregate read again. A row keeps the largest product of each
number of hops in a column of its own, so no struct has to be sorted for its maximum. Edges of nodes that nothing leads to are read for the first level only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evgraph.operators.components import ensure_checkpoint_dir


#: Starts of a group, about: states of a node that travel in one list at most.
GROUP = 1 << 16


def best_paths(edges: DataFrame, starts: DataFrame, most: int = 4, strength: str = "ES_edge", least: float = 0.0) -> DataFrame:
    """start, node, hops, product, score of the best path from each start (start) to each node it reaches in 1..most directed hops, with a score of
    at least `least`; ties go to fewer hops. edges: _from, _to and a strength above 0 and up to 1 (of parallel ones the strongest counts; others,
    null ones and null ends are left out; above 1 is an error). A start isn't a target of its own; null and repeated starts count once or not at all."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    s = F.col(strength).cast("double")
    usable = edges.where("_from is not null AND _to is not null AND _from <> _to").where(s > 0)
    within = F.when(s <= 1, s).otherwise(F.raise_error(F.lit("a strength is above 1")).cast("double"))
    step = usable.select(F.col("_from").alias("node"), F.col("_to").alias("next"), within.alias("s")).where(F.col("s") >= least)  # no path scores more than its weakest edge
    first = starts.select("start").where("start is not null").distinct()
    pair, p = ["start", "node"], [f"p{h}" for h in range(1, most + 1)]  # p<h>: largest product in h hops
    rows = first.join(step, F.col("start") == F.col("node")).select("start", F.col("next").alias("node"), F.col("s").alias("p1"))
    if most == 1:
        known = rows.groupBy(*pair).agg(F.max("p1").alias("p1"))
    else:
        key, parts = ["g", "node"], int(spark.conf.get("spark.sql.shuffle.partitions"))
        groups = max(1, math.ceil(first.count() / GROUP))  # one number
        onward = step.join(step.select(F.col("next").alias("to")).distinct(), F.col("node") == F.col("to"), "left_semi").groupBy("node", "next").agg(F.max("s").alias("s"))
        onward = onward.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "node", "next", "s")
        levels = [rows.select(F.pmod(F.xxhash64("start"), F.lit(groups)).cast("int").alias("g"), "node", "start", "p1").repartition(parts, *key)]
        for hops in range(1, most + 1):
            wide = [x.select(*key, "start", *[F.col(c) if i == h else F.lit(None).cast("double").alias(c) for i, c in enumerate(p[:hops])]) for h, x in enumerate(levels)]
            known = reduce(DataFrame.unionByName, wide).where("start <> node").groupBy(*key, "start").agg(*[F.max(c).alias(c) for c in p[:hops]])
            if hops == most:
                break
            # a product that fewer hops match goes no further; the start itself has 1 in no hops
            product = F.col(p[hops - 1])
            front = known.where(product > F.greatest(F.lit(0.0), *p[: hops - 1]) if hops > 1 else product.isNotNull())
            lists = front.groupBy(*key).agg(F.collect_list(F.struct("start", product.alias("product"))).alias("l"))
            going = lists.join(onward, key).select("g", F.col("next").alias("node"), "s", F.filter("l", lambda x: x["product"] * F.col("s") / (hops + 1) >= least).alias("l")).where(F.size("l") > 0)  # noqa: B023
            sent = going.select(*key, "s", F.transform("l", lambda x: x["start"]).alias("starts"), F.transform("l", lambda x: x["product"]).alias("products")).repartition(parts, *key)
            if hops % 4 == 0:
                sent = sent.checkpoint()  # else a plan of many levels holds each of them ever more often
            each = sent.select(*key, "s", F.explode(F.arrays_zip("starts", "products")).alias("x"))
            levels.append(each.select(*key, F.col("x.starts").alias("start"), (F.col("x.products") * F.col("s")).alias(p[hops])))
    each = F.array(*[F.struct((F.col(c) / h).alias("score"), F.lit(-h).alias("less"), F.col(c).alias("product")) for h, c in enumerate(p, 1)])
    best = known.select(*pair, F.array_max(F.filter(each, lambda x: x["product"].isNotNull())).alias("b"))
    return best.select(*pair, (-F.col("b.less")).alias("hops"), F.col("b.product").alias("product"), F.col("b.score").alias("score"))


#: Nodes of a start that travel in one list, about.
LIST = 1024


def trait_scores(loci: DataFrame, reach: DataFrame) -> DataFrame:
    """_from, node, score: the best -log10(adj_p) x path score over the loci (_from, _to, adj_p) of each _from, with the path from _to to the node (reach: `best_paths`).
    A p that is null or not above 0 gives none. What a start reaches travels to its loci as lists, in shares by a hash of the node where it is much: the largest scores are
    found by _from and share, and no row for each _from and node is shuffled."""
    ensure_checkpoint_dir(reach.sparkSession)
    strength = loci.where("adj_p > 0").select("_from", F.col("_to").alias("start"), (-F.log10(F.greatest("adj_p", F.lit(1e-300)))).alias("clear"))
    strength = strength.groupBy("_from", "start").agg(F.max("clear").alias("clear"))
    reach = reach.select("start", "node", "score").checkpoint()
    longest = reach.groupBy("start").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0  # one number: shares are the same for all starts, so they can meet
    shares = 1 << max(0, math.ceil(math.log2(max(longest, 1) / LIST)))
    lists = reach.groupBy("start", F.pmod(F.xxhash64("node"), F.lit(shares)).cast("int").alias("share")).agg(F.collect_list(F.struct("node", "score")).alias("l"))
    lists = lists.select("start", "share", F.transform("l", lambda x: x["node"]).alias("nodes"), F.transform("l", lambda x: x["score"]).alias("scores"))
    sent = strength.join(lists, "start").select("_from", "share", "clear", "nodes", "scores").repartition("_from", "share")
    each = sent.select("_from", "share", "clear", F.explode(F.arrays_zip("nodes", "scores")).alias("x")).select("_from", "share", F.col("x.nodes").alias("node"), (F.col("clear") * F.col("x.scores")).alias("score"))
    return each.groupBy("_from", "share", "node").agg(F.max("score").alias("score")).drop("share")


def biomarker_scores(influence: DataFrame, reach: DataFrame, evidence: DataFrame) -> DataFrame:
    """node, score: influence (node, influence; as a share of the largest) x the node's best path score to any outcome (reach: `best_paths` to the outcomes)
    x the mean ES_edge of its evidence (node, ES_edge). Nodes that lack one of the three are left out; without influence anywhere all scores are 0."""
    largest = influence.agg(F.max("influence").alias("largest"))
    share = influence.crossJoin(F.broadcast(largest)).select("node", F.coalesce(F.try_divide(F.col("influence"), F.col("largest")), F.lit(0.0)).alias("share"))  # one row
    best = reach.groupBy(F.col("start").alias("node")).agg(F.max("score").alias("best"))
    mean = evidence.groupBy("node").agg(F.avg("ES_edge").alias("mean"))
    return share.join(best, "node").join(mean, "node").select("node", (F.col("share") * F.col("best") * F.col("mean")).alias("score"))
