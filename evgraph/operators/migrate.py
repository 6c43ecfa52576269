"""Migration of edges from retired triples to their successors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.contract import edge_id


def migrate(edges: DataFrame, retirements: DataFrame, order: str = "edge_id") -> DataFrame:
    """Edges (with labels) after synonym, inverse, collapse and redirect moves. A retired edge keeps its properties under its
    successor's triple, with ends swapped where the plan says so, unless the target edge exists; then that one's
    properties stay. Always by the full triple, never by name alone. Running it twice changes nothing."""
    plan = retirements.select(F.col("type").alias("_type"), "from_label", "to_label", "superseded_by", "reverse")
    rows = edges.join(plan, ["_type", "from_label", "to_label"], "left")
    moved, swap = F.col("superseded_by").isNotNull(), F.coalesce("reverse", F.lit(False))
    new = rows.select(
        *[c for c in edges.columns if c not in ("_type", "_from", "_to", "from_label", "to_label", "edge_id")],
        F.coalesce("superseded_by", "_type").alias("_type"),
        F.when(swap, F.col("_to")).otherwise(F.col("_from")).alias("_from"), F.when(swap, F.col("_from")).otherwise(F.col("_to")).alias("_to"),
        F.when(swap, F.col("to_label")).otherwise(F.col("from_label")).alias("from_label"), F.when(swap, F.col("from_label")).otherwise(F.col("to_label")).alias("to_label"),
        F.col("edge_id").alias("_old_id"), moved.alias("_moved"),
    )
    new = new.withColumn("edge_id", F.when(F.col("_moved"), edge_id(F.col("_from"), F.col("_type"), F.col("_to"))).otherwise(F.col("_old_id")))
    tie = "_old_id" if order == "edge_id" else order
    rank = F.row_number().over(W.partitionBy("_type", "_from", "_to").orderBy("_moved", tie))
    return new.withColumn("_rank", rank).where("_rank = 1").select(*edges.columns)


def label_pairs(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("from_label", "to_label").alias("a"), F.greatest("from_label", "to_label").alias("b")).distinct()


def coverage_problems(before: DataFrame, after: DataFrame, retirements: DataFrame, active: DataFrame) -> DataFrame:
    """(problem, detail): label pairs that lost their connection, retired triples left, successors that aren't active types."""
    lost = label_pairs(before).join(label_pairs(after), ["a", "b"], "left_anti").select(F.lit("pair lost").alias("problem"), F.concat_ws("|", "a", "b").alias("detail"))
    triples = retirements.select(F.col("type").alias("_type"), "from_label", "to_label")
    left = after.join(triples, ["_type", "from_label", "to_label"], "left_semi").groupBy("_type").agg(F.count("*").alias("n")).select(F.lit("retired left").alias("problem"), F.concat_ws("|", "_type", F.col("n").cast("string")).alias("detail"))
    unknown = retirements.select(F.col("superseded_by").alias("type")).distinct().join(active.select("type").distinct(), "type", "left_anti").select(F.lit("successor not active").alias("problem"), F.col("type").alias("detail"))
    return lost.unionByName(left).unionByName(unknown)


def impact(before: DataFrame, after: DataFrame, retirements: DataFrame) -> DataFrame:
    """edges before and after, removed, removed_pct and the count of retired edges: one row."""
    triples = retirements.select(F.col("type").alias("_type"), "from_label", "to_label")
    retired = before.join(triples, ["_type", "from_label", "to_label"], "left_semi").agg(F.count("*").alias("retired"))
    one = before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after"))).crossJoin(retired)  # single rows
    return one.withColumn("removed", F.col("before") - F.col("after")).withColumn("removed_pct", F.round(F.coalesce(100 * F.try_divide(F.col("removed").cast("double"), F.col("before").cast("double")), F.lit(0.0)), 2))
