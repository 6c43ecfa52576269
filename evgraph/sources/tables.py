"""Reading and writing graph tables and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from evgraph.operators.components import ensure_checkpoint_dir
from evgraph.schema import TEMPORAL_FIELDS

INTERNAL = ["_label", "_from", "_to", "_type"]


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One record a line; blank lines give no row, fields that the schema doesn't name are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_graph(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The properties of records: without internal keys, maps as JSON text."""
    return properties(read_jsonl(spark, path, schema))


def properties(rows: DataFrame) -> DataFrame:
    """Own properties only; maps as JSON text."""
    out = rows.drop(*INTERNAL)
    return out.withColumns({f.name: F.to_json(f.name) for f in out.schema if isinstance(f.dataType, MapType | StructType)})


def cast_times(rows: DataFrame) -> DataFrame:
    """The temporal fields from ISO text to timestamps; a null stays null and so does what isn't a time."""
    return rows.withColumns({c: F.try_to_timestamp(F.col(c)) for c in TEMPORAL_FIELDS if c in rows.columns and rows.schema[c].dataType.simpleString() == "string"})


def iso(rows: DataFrame) -> DataFrame:
    return rows.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") for f in rows.schema if f.dataType.simpleString() == "timestamp"})


def write_graph(rows: DataFrame, path: str, partition: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    """One record a row, partitioned by label or type; JSON has ISO times."""
    (iso(rows) if form == "json" else rows).write.mode(mode).partitionBy(partition).format(form).save(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def replace(rows: DataFrame, root: str, partition: str) -> tuple[str, int]:
    """Replaces a table: writes a new version beside the old ones, to a path of its own (the write fails where anything is), checks that
    it holds the rows that went into the write, and returns the path that readers switch to."""
    spark = rows.sparkSession
    path = f"{root}/v-{uuid.uuid4().hex}"
    given = Observation()
    write_graph(rows.observe(given, F.count(F.lit(1)).alias("n")), path, partition)
    n, want = spark.read.parquet(path).count(), given.get["n"]
    if n != want:
        raise ValueError(f"{path} holds {n} rows of {want}")
    return path, n


def write_report(rows: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    rows.coalesce(1).write.mode("overwrite").json(path)

