"""Version histories: changes, stability, convergence, trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.functions.scoring import rounded


def with_changes(versions: DataFrame, key: str = "hypothesis_id") -> DataFrame:
    """delta_MC against the version before (null at first) and stability over the last five values."""
    by = W.partitionBy(key).orderBy("Hv")
    raw = versions.withColumn("_d", F.col("MC") - F.lag("MC").over(by))
    spread = F.coalesce(F.avg(F.abs("_d")).over(by.rowsBetween(-3, 0)), F.lit(0.0))
    return raw.withColumns({"delta_MC": rounded(F.col("_d")), "stability": rounded(F.greatest(F.lit(0.0), 1 - spread / 0.20))}).drop("_d")


def convergence(versions: DataFrame, below: float = 0.02) -> DataFrame:
    return versions.agg(F.count("delta_MC").alias("n"), F.count_if(F.abs("delta_MC") < below).alias("converged"))


def history_depth(versions: DataFrame, key: str = "hypothesis_id", least: int = 2) -> DataFrame:
    counts = versions.groupBy(key).agg(F.count("*").alias("vc")).where(F.col("vc") >= least)
    return counts.agg(F.count("*").alias("n"), F.round(F.avg("vc"), 4).alias("avg_versions"))


def trajectories(versions: DataFrame, key: str = "hypothesis_id", limit: int | None = 10) -> DataFrame:
    """Values in version order, and the current one; the first `limit` keys."""
    rows = F.array_sort(F.collect_list(F.struct("Hv", "MC")))
    out = versions.groupBy(key).agg(rows.alias("_r")).select(key, F.transform("_r", lambda x: x["MC"]).alias("trajectory"), F.element_at("_r", -1)["MC"].alias("current_MC"))
    return out.orderBy(key).limit(limit) if limit else out
