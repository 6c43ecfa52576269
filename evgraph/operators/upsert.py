"""Keyed upsert, deduplication, reference checks and load verification of graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """The row with the least order values of each key."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def upsert(current: DataFrame, updates: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Whole rows: the last update of a key replaces the current row. `order` exists in the updates only."""
    both = current.withColumn(order, F.lit(None).cast("long")).unionByName(updates)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc_nulls_last(order)))
    return both.withColumn("_rank", rank).where("_rank = 1").drop("_rank", order)


def patch(current: DataFrame, updates: DataFrame, keys: list[str], present: str = "present") -> DataFrame:
    """Sparse rows: of each update only the columns named in its array `present` count; a null among these removes the
    value, columns that aren't named stay. One update for each key."""
    old, new = current.alias("o"), updates.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    out = []
    for c in current.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in updates.columns:
            named = F.coalesce(F.array_contains(F.col(f"n.{present}"), c), F.lit(False))
            out.append(F.when(named, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}"))
    return old.join(new, on, "full_outer").select(*out)


def upsert_edges(current: DataFrame, updates: DataFrame, nodes: DataFrame, order: str = "seq") -> DataFrame:
    """Edges whose ends exist, one for each (_from, _type, _to)."""
    kept = with_known_ends(updates, nodes)
    return upsert(current, kept, ["_from", "_type", "_to"], order)


def with_known_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ids = nodes.select("uid")
    return edges.join(ids.withColumnRenamed("uid", "_from"), "_from", "left_semi").join(ids.withColumnRenamed("uid", "_to"), "_to", "left_semi").select(*edges.columns)


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(_from, _type, _to, missing): which end of an edge has no node."""
    ids = nodes.select("uid")
    key = edges.select("_from", "_type", "_to")
    ends = [key.join(ids.withColumnRenamed("uid", c), c, "left_anti").select("_from", "_type", "_to").withColumn("missing", F.lit(c)) for c in ("_from", "_to")]
    return ends[0].unionByName(ends[1])


def dedup_edges(edges: DataFrame, order: str | list[str]) -> DataFrame:
    """First wins on (type, from, to); null ends and self-loops go."""
    whole = edges.where(F.col("_from").isNotNull() & F.col("_to").isNotNull() & (F.col("_from") != F.col("_to")))
    return first_wins(whole, ["_type", "_from", "_to"], order)


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    """(rule, value, n, labels): uids held twice, and canonical ids held twice within a label."""
    uid = nodes.groupBy(F.col("uid").alias("value")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("entity_type")).alias("labels")).withColumn("rule", F.lit("uid"))
    own = nodes.groupBy("entity_type", "canonical_id").agg(F.count("*").alias("n")).select(F.concat_ws(":", "entity_type", "canonical_id").alias("value"), "n", F.array("entity_type").alias("labels"), F.lit("canonical_id").alias("rule"))
    return uid.unionByName(own).where("n > 1").select("rule", "value", "n", "labels")


def verify_load(loaded_nodes: DataFrame, loaded_edges: DataFrame, input_nodes: DataFrame, input_edges: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row for each table: loaded, input and manifest counts, and whether all agree. manifest: (table, expected)."""
    rows = None
    for name, loaded, given in (("nodes", loaded_nodes, input_nodes), ("edges", loaded_edges, input_edges)):
        one = loaded.agg(F.count("*").alias("loaded")).crossJoin(given.agg(F.count("*").alias("input"))).withColumn("table", F.lit(name))  # single rows
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(manifest, "table", "left").select("table", "loaded", "input", F.col("expected"), ((F.col("loaded") == F.col("input")) & F.col("loaded").eqNullSafe(F.col("expected"))).alias("ok"))
