"""Documented ad-hoc questions over nodes and scored edges (edges carry both labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def named(edges: DataFrame, nodes: DataFrame, side: str, *columns: str) -> DataFrame:
    """Joins columns of an edge's end, prefixed by the side (from or to)."""
    own = nodes.select(F.col("uid").alias(f"_{side}"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
    return edges.join(own, f"_{side}")


def real_edges(edges: DataFrame, a: str, b: str, limit: int = 25) -> DataFrame:
    rows = edges.where((F.col("from_label") == a) & (F.col("to_label") == b) & ~F.coalesce("is_synthetic", F.lit(False)))
    return rows.select("_from", "_type", "_to", "edge_aggregate_score").orderBy(F.desc("edge_aggregate_score"), "_from", "_to").limit(limit)


def types_in_layer(edges: DataFrame, layer: str) -> DataFrame:
    return edges.where(F.col("layer") == layer).groupBy("_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_type")


def channels_of(edges: DataFrame, start: str) -> DataFrame:
    return edges.where(F.col("_from") == start).select("_type", "_to", "evidence_type", "edge_aggregate_score", "edge_quality_tier").orderBy(F.desc("edge_aggregate_score"), "_to")


def directional(edges: DataFrame, nodes: DataFrame, target: str, order_by: str) -> DataFrame:
    """Signed edges into one target, by a property of their source."""
    rows = named(edges.where((F.col("_to") == target) & F.col("direction").isin(-1, 1)), nodes, "from", order_by)
    return rows.select("_from", "_type", "direction", F.col(f"from_{order_by}").alias(order_by)).orderBy(F.desc(order_by), "_from")


def breadth(edges: DataFrame, kind: str, limit: int = 20) -> DataFrame:
    rows = edges.where(F.col("_type") == kind).groupBy("_from").agg(F.countDistinct("_to").alias("n"), F.round(F.avg("effect_size"), 3).alias("mean_signal"))
    return rows.orderBy(F.desc("n"), F.desc("mean_signal"), "_from").limit(limit)


def contradicted(edges: DataFrame, limit: int = 25) -> DataFrame:
    rows = edges.where((F.col("concordance_flag") == "CONTRADICTORY") & (F.col("neg_count") > 0))
    return rows.select("_from", "_type", "_to", "pos_count", "neg_count", "conflict_score").orderBy(F.desc("conflict_score"), "_from", "_to").limit(limit)


def lists_of(edges: DataFrame, kind: str) -> DataFrame:
    return edges.where(F.col("_type") == kind).groupBy("_from").agg(F.array_sort(F.collect_set("_to")).alias("targets"))


def fingerprint(edges: DataFrame) -> DataFrame:
    return edges.agg(F.countDistinct("_type").alias("types"))
