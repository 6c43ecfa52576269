"""Centralities: degree, betweenness by levels, the role matrix over both, and the separation of two subgraphs.

Betweenness follows Brandes: from each source, nodes are reached level by level with the number of shortest paths to them; dependencies are then
summed up backwards along the same levels. All of it is joins and aggregates over edge tables, each level checkpointed. Nodes get numbers, and sources are dealt to
blocks of WIDTH: a row of a level is a node and a block, with a column for each source of the block, so an edge is met once for a block and a level, not once for each source.
For all nodes as sources the result is exact, for a sample it is scaled by how many sources there could be. Blocks are worked off in rounds of about ROWS rows,
whose levels are deleted when they are summed up: what is held at once doesn't grow with the number of sources, though the time for all of them is nodes x edges.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.components import ensure_checkpoint_dir, forget
from evgraph.operators.expand import numbered


def undirected(edges: DataFrame) -> DataFrame:
    """a, b: both directions of each edge, once; self-loops and null ends are left out."""
    rows = edges.where("_from is not null AND _to is not null AND _from <> _to").select(F.col("_from").alias("a"), F.col("_to").alias("b"))
    return rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree: how many other nodes an edge joins it to, whatever its direction and number."""
    return undirected(edges).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"))


#: Sources of a block: columns of a level. With many more the generated code of its aggregates is too long to be compiled.
WIDTH = 5

#: Pairs of a block and a node that a round may reach, about (one block at least); each stands in the few levels that the block's sources reach the node in.
ROWS = 1 << 21


def dependencies(both: DataFrame, starts: DataFrame, columns: int, most: int | None, held: list[DataFrame]) -> DataFrame:
    """k, d: over the sources (k, i), how much each node's shortest paths to others depend on it. both: both directions of each edge, by numbers. held: gets what it checkpoints."""
    width = range(columns)
    n, d = [f"n{i}" for i in width], [f"d{i}" for i in width]  # paths from each source of the block to the node, dependency of the source on it
    key, zero = ["block", "node"], F.lit(0.0)
    some = lambda columns: F.greatest(F.lit(-1.0), *columns) > 0
    place = F.pmod("i", F.lit(len(width)))
    front = starts.select(F.floor(F.col("i") / len(width)).alias("block"), F.col("k").alias("node"), *[F.when(place == i, 1.0).otherwise(0.0).alias(n[i]) for i in width])
    front = front.checkpoint()
    mask = sum((F.when(F.col(n[i]) > 0, 1 << i).otherwise(0) for i in width[1:]), F.when(F.col(n[0]) > 0, 1).otherwise(0))
    old = lambda level: level.select(*key, *[zero.alias(c) for c in n], mask.alias("old"))
    levels = [front]
    held.append(front)
    while most is None or len(levels) <= most:
        new = front.join(both, front["node"] == both["a"]).select("block", F.col("b").alias("node"), *n, F.lit(0).alias("old"))
        for level in levels[-2:]:  # on undirected edges a level touches only itself and its two neighbours
            new = new.unionByName(old(level))
        new = new.groupBy(*key).agg(*[F.sum(c).alias(c) for c in n], F.bit_or("old").alias("old"))
        new = new.select(*key, *[F.when(F.col("old").bitwiseAND(1 << i) > 0, 0.0).otherwise(F.col(n[i])).alias(n[i]) for i in width]).where(some([F.col(c) for c in n])).checkpoint()
        held.append(new)
        if new.isEmpty():
            break
        front = new
        levels.append(new)
    below = levels[-1].select(*key, *n, *[zero.alias(c) for c in d])
    out = [below.select(*key, *d)]
    for level in reversed(levels[:-1]):
        share = lambda i: F.when(F.col(n[i]) > 0, (1 + F.col(d[i])) / F.col(n[i])).otherwise(0.0)
        given = below.select("block", F.col("node").alias("b"), *[share(i).alias(d[i]) for i in width]).join(both, "b").select("block", F.col("a").alias("node"), *[zero.alias(c) for c in n], *d)
        given = given.unionByName(level.select(*key, *n, *[zero.alias(c) for c in d])).groupBy(*key).agg(*[F.sum(c).alias(c) for c in (*n, *d)])
        given = given.where(some([F.col(c) for c in n]))  # of the level itself; a column without paths there gets nothing
        below = given.select(*key, *n, *[(F.col(d[i]) * F.col(n[i])).alias(d[i]) for i in width]).checkpoint()
        held.append(below)
        out.append(below.select(*key, *d))
    every = out[0]
    for x in out[1:-1]:  # the last is level 0, each source to itself, which doesn't count
        every = every.unionByName(x)
    return every.select("node", sum((F.col(c) for c in d[1:]), F.col(d[0])).alias("d")).groupBy(F.col("node").alias("k")).agg(F.sum("d").alias("d"))


def betweenness(edges: DataFrame, sources: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """node, betweenness of each node that an edge touches, without direction: over all pairs of other nodes, the share of their shortest paths
    that pass through it. sources (node): only paths from these, scaled by nodes / sources; None: all nodes, exactly. `most`: only paths of up to so many
    hops; None: all, and as many levels as the longest has. Sources that no edge touches aren't counted."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    named = undirected(edges).checkpoint()
    nodes = named.select(F.col("a").alias("node")).distinct().withColumn("k", F.monotonically_increasing_id()).checkpoint()  # numbers hold once they are written
    number = lambda c: nodes.select(F.col("node").alias(c), F.col("k").alias(f"{c}_k"))
    both = named.join(number("a"), "a").join(number("b"), "b").select(F.col("a_k").alias("a"), F.col("b_k").alias("b")).checkpoint()
    starts = nodes if sources is None else nodes.join(sources.select("node"), "node", "left_semi")
    total = nodes.count()
    starts = numbered(starts.select("k", F.lit(0).alias("one")), "one", "k").checkpoint()
    chosen = starts.count()
    width = range(min(WIDTH, max(chosen, 1)))
    some = max(1, ROWS // max(total, 1)) * len(width)  # sources of a round
    each = None
    for low in range(0, max(chosen, 1), some):
        held: list[DataFrame] = []
        found = dependencies(both, starts if chosen <= some else starts.where((F.col("i") >= low) & (F.col("i") < low + some)), len(width), most, held)
        before, each = each, found if chosen <= some else (found if each is None else found.unionByName(each).groupBy("k").agg(F.sum("d").alias("d"))).checkpoint()
        if chosen > some:
            for x in [*held, *filter(None, [before])]:
                forget(x)
            held.clear()
            spark._jvm.System.gc()  # shuffle files go when the driver collects what refers to them
    scale = total / (2 * chosen) if chosen else 0.0
    return nodes.join(each, "k", "left").select("node", F.coalesce(F.col("d") * scale, F.lit(0.0)).alias("betweenness"))


def exact_quantile(values: DataFrame, column: str, share: float, buckets: int = 4096) -> float | None:
    """The least value v of the column such that at least `share` of the rows that have one are at most v. Exact: rows are counted in buckets of the value range, then
    only the bucket that holds the quantile is looked into, until all its rows have one value; the driver sees a few numbers a round."""
    rows = values.select(F.col(column).cast("double").alias("v")).where("v is not null AND NOT isnan(v)")
    n, lo, hi = rows.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    wanted = max(1, math.ceil(round(share * n, 9)))  # the rank of the quantile, from 1
    while lo < hi:
        width = (hi - lo) / buckets
        place = F.least(F.floor((F.col("v") - lo) / width), F.lit(buckets - 1)) if width > 0 else (F.col("v") > lo).cast("long")
        counts = rows.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy(place.alias("k")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        found = counts.withColumn("so_far", F.sum("n").over(W.orderBy("k"))).where(F.col("so_far") >= wanted).orderBy("k").first()  # at most `buckets` rows
        wanted -= found["so_far"] - found["n"]
        lo, hi = found["lo"], found["hi"]
    return lo


def roles(centralities: DataFrame, degree: float, between: float) -> DataFrame:
    """Adds role by two thresholds: at or above both a hub, by degree only a local hub, by betweenness only a bottleneck, else peripheral."""
    many, central = F.col("degree") >= degree, F.col("betweenness") >= between
    return centralities.withColumn("role", F.when(many & central, "hub").when(many, "local hub").when(central, "structural bottleneck").otherwise("peripheral"))


def role_matrix(edges: DataFrame, between: DataFrame, share: float = 0.9) -> DataFrame:
    """node, degree, betweenness, role of the nodes of `between` (node, betweenness); both thresholds are exact quantiles: `share` of
    the nodes lie at or below each."""
    both = degrees(edges).join(between, "node").checkpoint()
    d, b = (exact_quantile(both, c, share) for c in ("degree", "betweenness"))
    return roles(both, d if d is not None else 0.0, b if b is not None else 0.0)


def separation(edges: DataFrame, first: str, second: str) -> DataFrame:
    """node, first, second, separation: each node's degree centrality (neighbours / (nodes - 1) of the subgraph) among the edges that the Boolean column `first` marks and
    among those of `second`, and how far they are apart. One pass carries a state for each subgraph; an edge may belong to both. Nodes of neither are left out."""
    rows = edges.where("_from is not null AND _to is not null AND _from <> _to").select(F.col("_from").alias("a"), F.col("_to").alias("b"), F.coalesce(first, F.lit(False)).alias("x"), F.coalesce(second, F.lit(False)).alias("y")).where("x OR y")
    both = rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b"), "x", "y")).groupBy("a", "b").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    each = both.groupBy(F.col("a").alias("node")).agg(F.count_if("x").alias("x"), F.count_if("y").alias("y"))
    sizes = each.agg(F.count_if(F.col("x") > 0).alias("n_x"), F.count_if(F.col("y") > 0).alias("n_y"))
    share = lambda d, n: F.coalesce(F.try_divide(F.col(d).cast("double"), (F.col(n) - 1).cast("double")), F.lit(0.0))
    out = each.crossJoin(F.broadcast(sizes)).select("node", share("x", "n_x").alias("first"), share("y", "n_y").alias("second"))  # one row
    return out.withColumn("separation", F.abs(F.col("first") - F.col("second")))
