"""Graph aggregates and bounded traversals over node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.operators.components import connected_components, ensure_checkpoint_dir


def totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes, edges, types: one row."""
    return nodes.agg(F.count("*").alias("nodes")).crossJoin(edges.agg(F.count("*").alias("edges"), F.countDistinct("_type").alias("types")))  # single rows


def component_summary(edges: DataFrame, without: list[str] | None = None) -> DataFrame:
    """components, largest, covered (nodes that touch a remaining edge)."""
    kept = edges.where(~F.col("_type").isin(*without)) if without else edges
    found = connected_components(kept, "_from", "_to")
    sizes = found.groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("components"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("covered"))


def hops(starts: DataFrame, edges: DataFrame, most: int, targets: DataFrame | None = None) -> DataFrame:
    """Least number of hops (1..most) from each start: (start, node, hops), one row for each node reached; with `targets`
    (start, target) only these rows. Each level is one join, deduplicated and without nodes already reached. With targets, a start whose targets are
    all found goes no further, and the last level is met from the targets' side."""
    ensure_checkpoint_dir(edges.sparkSession)
    step = edges.select(F.col("_from").alias("node"), F.col("_to").alias("next")).distinct().checkpoint()  # every level reads it
    front = starts.select("start", F.col("start").alias("node")).distinct()
    seen = front.withColumn("hops", F.lit(0))
    left = targets.select("start", F.col("target").alias("node")).distinct() if targets is not None else None
    for level in range(1, most + 1):
        if left is not None and level == most:
            before = left.select("start", F.col("node").alias("next")).join(step, "next").select("start", "node", "next")
            met = before.join(front, ["start", "node"], "left_semi").select("start", F.col("next").alias("node")).distinct().withColumn("hops", F.lit(level))
            seen = seen.unionByName(met.join(seen.select("start", "node"), ["start", "node"], "left_anti"))
            break
        new = front.join(step, "node").select("start", F.col("next").alias("node")).distinct()
        front = new.join(seen.select("start", "node"), ["start", "node"], "left_anti").checkpoint()
        seen = seen.unionByName(front.withColumn("hops", F.lit(level)))
        if left is not None:
            left = left.join(front, ["start", "node"], "left_anti").checkpoint()
            front = front.join(left.select("start").distinct(), "start", "left_semi")
    found = seen.where("hops > 0")
    return found.join(targets.select("start", F.col("target").alias("node")), ["start", "node"], "left_semi") if targets is not None else found


def cognate_pairs(edges: DataFrame, kind: str, pairs: int = 150) -> DataFrame:
    """The first pairs (by uid) that edges of a type join."""
    return edges.where(F.col("_type") == kind).select(F.col("_from").alias("start"), F.col("_to").alias("target")).distinct().orderBy("start", "target").limit(pairs)


def alternative_paths(edges: DataFrame, kind: str, pairs: int = 150, most: int = 4) -> DataFrame:
    """pairs, with_path, mean_length: how the pairs joined by a type are connected without it, in 1..most directed hops."""
    ensure_checkpoint_dir(edges.sparkSession)
    chosen = cognate_pairs(edges, kind, pairs).checkpoint()  # `pairs` rows that several joins read
    found = hops(chosen, edges.where(F.col("_type") != kind), most, chosen)
    joined = chosen.join(found, (chosen["start"] == found["start"]) & (chosen["target"] == found["node"]), "left")
    return joined.agg(F.count("*").alias("pairs"), F.count("hops").alias("with_path"), F.round(F.avg("hops"), 4).alias("mean_length"))


def hub_reach(edges: DataFrame, first: str, second: str, targets_total: int | Column, sources: int = 10) -> DataFrame:
    """sources, reaching, mean_reach, reach_pct: distinct targets over `-first-> hub -second->`, averaged over the sources that
    reach any; the share is of all possible targets."""
    legs = edges.where(F.col("_type") == first).select(F.col("_from").alias("s"), F.col("_to").alias("hub")).distinct()
    chosen = legs.select("s").distinct().orderBy("s").limit(sources)
    onward = edges.where(F.col("_type") == second).select(F.col("_from").alias("hub"), F.col("_to").alias("t")).distinct()
    reach = legs.join(chosen, "s", "left_semi").join(onward, "hub").groupBy("s").agg(F.countDistinct("t").alias("n"))
    total = targets_total if isinstance(targets_total, Column) else F.lit(targets_total)
    out = chosen.join(reach, "s", "left").agg(F.count("*").alias("sources"), F.count("n").alias("reaching"), F.round(F.avg("n"), 4).alias("mean_reach"))
    return out.withColumn("reach_pct", F.round(F.coalesce(F.try_divide(100 * F.col("mean_reach"), total.cast("double")), F.lit(0.0)), 2))


def gap_verdict(pct_with_path: Column, mean_length: Column, reach_pct: Column) -> Column:
    return F.when(pct_with_path <= 80, "NOT CONFIRMED").when((mean_length <= 2.2) | (reach_pct > 20), "SEVERE").otherwise("CONFIRMED BUT BOUNDED")


def gap_report(edges: DataFrame, cognate: str, first: str, second: str, targets_total: int, pairs: int = 150) -> DataFrame:
    """Composition: pairs of the cognate type, their alternative paths, hub reach, components with and without the type, verdict."""
    paths = alternative_paths(edges, cognate, pairs)
    reach = hub_reach(edges, first, second, targets_total)
    count = edges.where(F.col("_type") == cognate).agg(F.count("*").alias("cognate_edges"))
    with_, without = (component_summary(edges, x).select(F.col("components").alias(n)) for x, n in ((None, "components_with"), ([cognate], "components_without")))
    out = count
    for one in (paths, reach, with_, without):  # each has a single row
        out = out.crossJoin(one)
    pct = F.round(100 * F.try_divide(F.col("with_path").cast("double"), F.col("pairs").cast("double")), 1)
    return out.withColumn("pct_with_path", F.coalesce(pct, F.lit(0.0))).withColumn("verdict", gap_verdict(F.col("pct_with_path"), F.col("mean_length"), F.col("reach_pct")))


def membership_coverage(nodes: DataFrame, edges: DataFrame, subject: str, typed: str, anchors: dict[str, list[str]]) -> DataFrame:
    """subjects, with_membership, reachable labels by other types in one hop, and for each anchor whether any of its labels is among them."""
    own = nodes.where(F.col("entity_type") == subject).select(F.col("uid").alias("_from"))
    out = edges.join(own, "_from", "left_semi")
    typed_n = out.where(F.col("_type") == typed).agg(F.countDistinct("_from").alias("with_membership"))
    labels = out.where(F.col("_type") != typed).join(nodes.select(F.col("uid").alias("_to"), "entity_type"), "_to").agg(F.array_sort(F.collect_set("entity_type")).alias("reachable"))
    one = own.agg(F.count("*").alias("subjects")).crossJoin(typed_n).crossJoin(labels)  # single rows
    for name, wanted in anchors.items():
        one = one.withColumn(name, F.size(F.array_intersect("reachable", F.array(*[F.lit(x) for x in wanted]))) > 0)
    return one


def degree_by_label(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """label, nodes, mean_degree, max_degree."""
    ends = edges.select(F.col("_from").alias("uid")).unionByName(edges.select(F.col("_to").alias("uid"))).groupBy("uid").agg(F.count("*").alias("d"))
    each = nodes.select("uid", "entity_type").join(ends, "uid", "left").withColumn("d", F.coalesce("d", F.lit(0)))
    return each.groupBy("entity_type").agg(F.count("*").alias("nodes"), F.round(F.avg("d"), 4).alias("mean_degree"), F.max("d").alias("max_degree"))


def hub_pairs(edges: DataFrame, hub_label: str) -> DataFrame:
    """One row: pairs of nodes that share a neighbour of the hub label, counted for each hub (n (n - 1) / 2)."""
    near = edges.select(F.col("_from").alias("a"), F.col("_to").alias("hub"), F.col("to_label").alias("l")).unionByName(edges.select(F.col("_to").alias("a"), F.col("_from").alias("hub"), F.col("from_label").alias("l")))
    each = near.where(F.col("l") == hub_label).select("a", "hub").distinct().groupBy("hub").agg(F.count("*").alias("n"))
    return each.agg(F.count("*").alias("hubs"), F.coalesce(F.sum((F.col("n") * (F.col("n") - 1) / 2).cast("long")), F.lit(0)).alias("incidences"))


def projection(edges: DataFrame, without_labels: list[str]) -> DataFrame:
    """Edges (with labels) that touch none of the labels."""
    return edges.where(~F.col("from_label").isin(*without_labels) & ~F.col("to_label").isin(*without_labels))


def projection_size(edges: DataFrame, without_labels: list[str]) -> DataFrame:
    kept = projection(edges, without_labels)
    ends = kept.select(F.col("_from").alias("uid")).unionByName(kept.select(F.col("_to").alias("uid")))
    return kept.agg(F.count("*").alias("edges")).crossJoin(ends.agg(F.countDistinct("uid").alias("nodes")))  # single rows


def undirected_paths(edges: DataFrame, start: str, to_label: str, avoid: list[str], nodes: DataFrame, most: int = 4, limit: int = 5) -> DataFrame:
    """(target, hops) of the nearest nodes of a label in at most `most` undirected hops, avoiding labels as inner nodes."""
    kept = edges.where(~F.col("from_label").isin(*avoid) & ~F.col("to_label").isin(*avoid)) if avoid else edges
    both = kept.select("_from", "_to").unionByName(kept.select(F.col("_to").alias("_from"), F.col("_from").alias("_to")))
    begin = nodes.where(F.col("uid") == start).select(F.col("uid").alias("start"))
    found = hops(begin, both, most)
    goal = nodes.where(F.col("entity_type") == to_label).select(F.col("uid").alias("node"))
    return found.join(goal, "node", "left_semi").select(F.col("node").alias("target"), "hops").where(F.col("node") != start).orderBy("hops", "target").limit(limit)


def retired_counts(edges: DataFrame, retirements: DataFrame) -> DataFrame:
    """Edges (with labels) on retired triples, by type, most first."""
    triples = retirements.select(F.col("type").alias("_type"), "from_label", "to_label")
    return edges.join(triples, ["_type", "from_label", "to_label"], "left_semi").groupBy("_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_type")


def top_by_count(rows: DataFrame, key: str, limit: int) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(limit)

