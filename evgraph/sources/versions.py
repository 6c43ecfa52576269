"""Versioned tables: keyed merges that rewrite only the buckets they touch, and a commit record that names the current version.

A table's rows lie in buckets by a hash of their key. A write puts the new contents of the buckets it touches into a folder of its own; then a record is
put in place that says for each bucket which folder holds it. Files are never changed, so buckets that a merge doesn't touch keep their files, readers see whole versions
and an old version can be read as long as its files are kept.

    <root>/data/<write>/_bucket=5/...    files of one write
    <root>/commits/0000000007.json       the record of version 7

The record of a version is put there only if there is none: of two writers that started from the same version one wins, and the other gets
`Conflict`, with nothing changed for readers. This needs a file system whose rename doesn't replace files (HDFS and the like).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evgraph.operators.components import ensure_checkpoint_dir

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one wanted to."""


class VersionedTable:
    """A table below `root`. Keys and number of buckets are set by the first write; a bucket is written by one task, so choose as many that one stays small."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ reading

    def versions(self) -> list[int]:
        """All versions that are committed, oldest first."""
        return sorted(int(name.removesuffix(".json")) for name in self._names(f"{self.root}/commits") if name.endswith(".json"))

    def record(self, version: int | None = None) -> dict:
        """The commit record of a version, or of the current one."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise LookupError(f"{self.root} has no version {'' if version is None else version}".rstrip())
        text = self.spark.read.text(self._commit(known[-1] if version is None else version), wholetext=True).first()[0]
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, or of the current one at the time of the call."""
        return self._rows(self.record(version))

    # ------------------------------------------------------------ writing

    def replace(self, rows: DataFrame, keys: list[str], buckets: int = 64, after: int | None = None) -> int:
        """A new version that holds these rows only. `after`: the version that must be the current one (None: whichever is; -1: none yet)."""
        if BUCKET in rows.columns:
            raise ValueError(f"a column named {BUCKET}")
        base = self._base(after)
        head = {"keys": keys, "buckets": buckets, "schema": json.loads(rows.schema.json())}
        return self._commit_record(base, head | {"folders": self._write(rows, head)})

    def merge(self, updates: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], after: int | None = None) -> int:
        """A new version in which how(rows, updates) stands for the rows of the buckets that the updates' keys fall into. `how` may drop, change or add
        rows with keys of the updates only (as `upsert` and `patch` do). Updates without a key's column are an error; without updates nothing is written."""
        ensure_checkpoint_dir(self.spark)
        base = self._base(after)
        now = self.record(base)
        updates = updates.checkpoint()  # read twice, and the same both times
        place = self._bucket(now, updates)
        touched = sorted(r[0] for r in updates.select(place.alias("b")).distinct().collect())  # at most as many numbers as there are buckets
        if not touched:
            return base
        held = now | {"folders": {k: f for k, f in now["folders"].items() if int(k) in touched}}
        schema = self._schema(now)
        merged = how(self._rows(held), updates).select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in schema])
        written = self._write(merged, now)
        if not set(map(int, written)) <= set(touched):
            raise ValueError("the merge made rows of keys that no update has")
        kept = {k: f for k, f in now["folders"].items() if int(k) not in touched}
        return self._commit_record(base, {k: now[k] for k in ("keys", "buckets", "schema")} | {"folders": kept | written})

    # ------------------------------------------------------------ inside

    def _commit(self, version: int) -> str:
        return f"{self.root}/commits/{version:010d}.json"

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _base(self, after: int | None) -> int:
        current = (self.versions() or [-1])[-1]
        if after is not None and after != current:
            raise Conflict(f"{self.root} is at version {current}, not {after}")
        return current

    def _schema(self, record: dict) -> StructType:
        return StructType.fromJson(record["schema"])

    def _bucket(self, head: dict, rows: DataFrame) -> Column:
        kinds = {c["name"]: c["type"] for c in head["schema"]["fields"]}
        return F.pmod(F.xxhash64(*[F.col(k).cast(kinds[k]) for k in head["keys"]]), F.lit(head["buckets"])).cast("int")

    def _rows(self, record: dict) -> DataFrame:
        schema = self._schema(record)
        folders = [f"{self.root}/data/{f}/{BUCKET}={k}" for k, f in sorted(record["folders"].items())]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, head: dict) -> dict[str, str]:
        """Writes rows by buckets to a folder of their own; {bucket: folder}."""
        name = uuid.uuid4().hex
        rows.withColumn(BUCKET, self._bucket(head, rows)).repartition(head["buckets"], BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{name}")
        return {x.split("=")[1]: name for x in self._names(f"{self.root}/data/{name}") if x.startswith(f"{BUCKET}=")}

    def _commit_record(self, base: int, record: dict) -> int:
        """Puts the record of the version after `base` in place, if there is none."""
        version = base + 1
        jvm = self.spark._jvm
        (draft, fs), (target, _) = self._path(f"{self.root}/commits/.{uuid.uuid4().hex}"), self._path(self._commit(version))
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(record | {"version": version}).encode()))
        out.close()
        never_replace = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        never_replace[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, target, never_replace)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise Conflict(f"{self.root} has a version {version} already") from None
            raise
        return version
