"""Connected components of an edge table by alternating large and small stars.

Each round is a fixed number of joins and aggregates, the number of rounds is logarithmic in practice (chains included),
and lineage is cut with checkpoint() in the folder that all executors share. The driver sees one row a round: whether any
node still has a part in two stars. Least neighbours are checkpointed before they are joined back, so that both sides of that join are
plain exchanges and adaptive execution can split the partition of a hub that a large share of all edges touches. These joins are merges by hint: where
least neighbours are few enough to be broadcast, every round would gather them in the driver, several times over with the rounds before not yet cleared.
A checkpoint keeps the size that the planner guessed, and a join's guess is the product of both sides: carried from round to round its digits double with each
join, and the guess alone fills the driver. So each checkpoint here is read back without one.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the session's folder. Only where none is set is one made, and only in local mode (tests): executors elsewhere
    couldn't see it, so a cluster without the setting is an error."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(folder)


def checkpointed(rows: DataFrame) -> DataFrame:
    """checkpoint() without the size that the plan before it was guessed to have, for rows that are joined round after round."""
    done, spark = rows.checkpoint(), rows.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False), spark)


def forget(rows: DataFrame) -> None:
    """Deletes the files of a checkpoint that nothing reads any more: Spark keeps them to the end unless it is told otherwise."""
    file, context = rows._jdf.queryExecution().logical().rdd().getCheckpointFile(), rows.sparkSession.sparkContext
    if file.isDefined():
        path = context._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 60) -> DataFrame:
    """`node, component` of every node that an edge touches; the component is its least node. Edges have no direction; self-loops
    and rows with a null end are left out of the work, though a self-loop's node is a component. Raises an error if edges still change
    after the last round."""
    ensure_checkpoint_dir(edges.sparkSession)
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    e = checkpointed(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    loops = e.where("u = v").select("u")
    e = e.where("u <> v")
    for _ in range(rounds):
        # done if no node is both an end and a centre, or the end of two edges: an exchange, but it saves a last round
        parts = e.select("u", F.lit(1).alias("end"), F.lit(0).alias("centre")).unionByName(e.select(F.col("v").alias("u"), F.lit(0).alias("end"), F.lit(1).alias("centre")))
        busy = parts.groupBy("u").agg(F.sum("end").alias("end"), F.max("centre").alias("centre")).where("end + centre > 1")
        if not busy.limit(1).count():
            break
        both = e.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(e.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = checkpointed(both.join(least.hint("merge"), "a").where("b > a and b <> m").select(F.col("b").alias("u"), F.col("m").alias("v")))  # read twice
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    star = e.groupBy("u").agg(F.min("v").alias("component"))
    nodes = star.select(F.col("u").alias("node"), "component").unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
    return nodes.unionByName(loops.select(F.col("u").alias("node"), F.col("u").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
