"""WARC archives with revisit records.

Writing: only headers (page, digest, length) are shuffled by payload digest to find equal payloads; of those the largest page
id becomes the response and the others revisits that refer to it. The payload then moves once, dealt by a hash of page and digest to
as many partitions as archives are wanted: an archive holds about ARCHIVE_BYTES, and more only by its largest page. Each
record gets fresh headers and is a gzip member of its own, so that a reader can begin at any record. Spark's text sink
writes the members, so archives go to any store Spark writes to and a lost task is written again, with the same bytes.

Reading: an archive's compressed bytes are held, its records are inflated and cut by Content-Length one after another, payload digests are
computed anew, and revisits are joined to their response by digest. Hot digests are salted on both joins.

A null payload is empty, and payloads under `least` bytes are always responses. A null page id counts as smaller than any. Rows
that share both the payload and the largest page id are all responses. A null url is written as an empty one. Other
columns aren't read. An empty table gives an archive without records and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import lean, shared_path

END = "\r\n\r\n"
SALTS = 32
ARCHIVE_BYTES = 16 << 20
#: About the bytes of a record's headers.
HEADERS = 600
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS = "record_id string, page_id long, record_type string, url string, payload_digest string, refers_to_id string, payload string, payload_bytes long"


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str) -> DataFrame:
    """Joins a side whose keys may be hot to one that has a row for each key."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def record_id(page: Column, digest: Column) -> Column:
    """A uuid of the page and its payload, the same whenever a task is run again."""
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def assign(pages: DataFrame, least: int) -> DataFrame:
    """page_id, digest, keeper and its url of each page that is to be a revisit."""
    heads = pages.select("page_id", "url", "digest").where(F.octet_length("payload") >= least)
    keep = heads.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("keeper"), F.count("*").alias("n"))
    keep = keep.where((F.col("n") > 1) & F.col("keeper.page_id").isNotNull()).select("digest", "keeper")
    found = salted_join(heads.select("page_id", "digest"), keep, "digest", F.col("page_id"), "inner")
    return found.where(~F.col("page_id").eqNullSafe(F.col("keeper.page_id"))).select("page_id", "digest", F.col("keeper.page_id").alias("refers_to"), F.col("keeper.url").alias("refers_url")).distinct()


def member(record: bytes) -> bytes:
    """A record as a gzip member without its last byte, which the sink's separator (a zero byte) puts back. That byte is the top one of the
    record's length, so a record of 16 MB or more gets an empty member behind it, whose length does end in zero."""
    out = gzip.compress(record, 6, mtime=0)
    return (out if out[-1] == 0 else out + gzip.compress(b"", 6, mtime=0))[:-1]


def members(batches):
    for batch in batches:
        column = batch.column(0)
        for lo, hi in slices(column, 4 << 20):
            yield pa.record_batch([pa.array([member(r) for r in column.slice(lo, hi - lo).cast(pa.binary()).to_pylist()], pa.binary())], names=["value"])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000, date: str = "2026-01-01T00:00:00Z") -> None:
    """Writes deduplicated archives of about ARCHIVE_BYTES below a path; the path must be new."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    total = pages.agg(F.sum(F.octet_length("payload") + HEADERS).alias("b")).first()["b"] or 0
    archives = max(1, -(-total // ARCHIVE_BYTES))
    revisits = assign(pages, least)
    # null-safe on the id: rows without one may be revisits too
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    named = revisits.withColumn("_k", F.concat_ws("|", key, F.col("digest"))).drop("page_id", "digest")
    rows = pages.withColumn("_k", F.concat_ws("|", key, F.col("digest"))).repartition(archives, "_k").join(named.hint("merge"), "_k", "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    uri = lambda c: F.regexp_replace(c, r"[\r\n]", " ")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri(F.col("url")),
        F.coalesce(F.concat(F.lit("\r\nX-Page-ID: "), F.col("page_id").cast("string")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")), F.lit("\r\nWARC-Refers-To-Target-URI: "), uri(F.col("refers_url")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit(END), F.col("block"), F.lit(END),
    )
    packed = rows.withColumn("block", block).select(head.alias("value")).mapInArrow(lean(members), "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").mode("errorifexists").text(path)


def parse(raw: bytes):
    """Records of one archive, one after another: header fields and the block."""
    stream = io.BytesIO(raw) if raw[:2] != b"\x1f\x8b" else gzip.GzipFile(fileobj=io.BytesIO(raw))
    while stream.readline():  # the version
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        stream.read(len(END))
        yield fields, block


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives below a path; without `payloads` only their lengths and digests."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                out: list[tuple] = []
                held = 0
                for fields, block in parse(content.as_py()):
                    payload = block.partition(b"\r\n\r\n")[2]
                    whole = fields["warc-type"] == "response"
                    page = fields.get("x-page-id")
                    out.append((
                        fields["warc-record-id"], int(page) if page else None, fields["warc-type"], fields.get("warc-target-uri", ""),
                        hashlib.sha1(payload).hexdigest() if whole else fields["warc-payload-digest"].removeprefix("sha1:"),
                        fields.get("warc-refers-to"), payload.decode() if whole and payloads else None, len(payload) if whole else None,
                    ))
                    held += len(payload) if payloads else 0
                    if len(out) >= 2000 or held > 4 << 20:
                        yield rows(out)
                        out, held = [], 0
                if out:
                    yield rows(out)

    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Adds to each revisit its response's page id (`refers_to`) and payload length."""
    revisits, responses = (records.where(F.col("record_type") == t) for t in ("revisit", "response"))
    originals = responses.groupBy("payload_digest").agg(F.max(F.struct("page_id", "payload_bytes")).alias("original"))
    originals = originals.join(revisits.select("payload_digest").distinct(), "payload_digest")
    found = salted_join(revisits, originals, "payload_digest", F.col("page_id"), "left")
    found = found.withColumn("payload_bytes", F.col("original.payload_bytes")).withColumn("refers_to", F.col("original.page_id")).drop("original")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and resolves their revisits."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path, **options)
    return resolve(read(spark, path, payloads=False))
