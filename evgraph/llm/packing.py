"""Packing of token pieces into sequences of fixed capacity by exact-complement hashing.

The number of different lengths is bounded by the capacity, so the plan is made from a histogram (at most
`capacity` rows) and not from pieces. For each length, longest first, the gap it leaves is looked up in an index of single
lengths, sums of two and sums of three (`Sums`); combinations that fill it exactly are consumed as often as all their counts
allow. What is left goes by best fit, longest first. Pieces then find their place by their rank within their length.

Ranks are counted by (length, bucket of the row's hash), so a length that a third of all pieces share is spread over
many tasks. Pieces of equal length may change places; everything else is fixed. Null texts are empty documents, which
still get the closing id. An empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.llm.bpe import encode
from evgraph.llm.common import lean, with_checkpoint_dir

CAPACITY = 4096


class Sums:
    """Availability of piece lengths, and an index from sums to the single lengths, pairs and triples that make them.

    Pairs are held for every sum, the longer piece first and as long as possible. A triple is a single length with a pair of the
    remaining sum. Pieces only get fewer, so what an index entry has passed over never comes back, and each entry is read once."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count = [0] * (capacity + 1)
        for length, n in counts.items():
            self.count[length] += int(n)
        self.taken = [0] * (capacity + 1)
        lengths = np.array([x for x in range(1, capacity) if self.count[x]], dtype=np.int32)
        longer = [np.full(n, x, np.int32) for x, n in zip(lengths.tolist(), np.searchsorted(lengths, np.minimum(lengths, capacity - 1 - lengths), side="right").tolist(), strict=True)]
        sums = [x + lengths[: len(x)] for x in longer]
        longer, sums = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (longer, sums))
        order = np.lexsort((-longer, sums))
        self.longer = array("i", longer[order].tobytes())
        self.pair_at = np.searchsorted(sums[order], np.arange(capacity + 2)).tolist()
        self.pair_end = self.pair_at[1:]
        self.triple_at = list(range(-1, capacity + 1))

    def times(self, combination: tuple[int, ...]) -> int:
        """How often a combination can be taken."""
        return min(self.count[x] // combination.count(x) for x in combination)

    def pair(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, int] | None:
        """Two available lengths of this sum, beside the pieces already held."""
        start, end, count, longer = self.pair_at[total], self.pair_end[total], self.count, self.longer
        for i in range(start, end):
            x = longer[i]
            y = total - x
            if count[x] and count[y] and (x != y or count[x] > 1):
                if i > start == self.pair_at[total]:
                    self.pair_at[total] = start = i
                if not held or self.times((x, y, *held)):
                    return x, y
                start = -1  # from here on entries may still serve others
        if start >= 0:
            self.pair_at[total] = end
        return None

    def triple(self, total: int, held: tuple[int, ...]) -> tuple[int, int, int] | None:
        first = True
        for x in range(self.triple_at[total], 0, -1):
            if self.count[x] and (two := self.pair(total - x)):
                first = False
                if self.times((x, *held)) and (two := self.pair(total - x, (x, *held))):
                    return (x, *two)
            elif first:
                self.triple_at[total] = x - 1
        return None

    def filling(self, gap: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to the gap, beside the pieces held."""
        if self.count[gap] and self.times((gap, *held)):
            return (gap,)
        return self.pair(gap, held) or self.triple(gap, held)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int]], int]:
    """(length, first rank, first sequence, offset) of each run of ranks, and the number of sequences. The pieces of a run
    go to one sequence each, one after another."""
    supply, runs, sequences = Sums(counts, capacity), [], 0

    def place(combination: tuple[int, ...], times: int) -> None:
        nonlocal sequences
        offset = 0
        for x in combination:
            runs.append((x, supply.taken[x], sequences, offset))
            supply.taken[x] += times
            offset += x
        sequences += times

    for length in range(capacity, 0, -1):
        while supply.count[length] > 0:
            rest = supply.filling(capacity - length, (length,)) if length < capacity else ()
            if rest is None:
                break
            combination = (length, *rest)
            n = supply.times(combination)
            for x in combination:
                supply.count[x] -= n
            place(combination, n)
    # best fit of the rest: open bins by the gap they have, each entry (how many, their pieces)
    bins: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    gaps = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        left = supply.count[length]
        while left:
            at = np.flatnonzero(gaps[length:])
            if at.size:
                gap = int(at[0]) + length
                n, held = bins[gap].pop()
                use = min(n, left)
                if n > use:
                    bins[gap].append((n - use, held))
                gaps[gap] = bool(bins[gap])
            else:
                gap, use, held = capacity, max(1, left // (capacity // length)), ()
            fit = 1 if held else min(left // use, capacity // length)
            bins[gap - fit * length].append((use, held + (length,) * fit))
            gaps[gap - fit * length] = True
            left -= use * fit
    for entries in bins.values():
        for n, held in entries:
            place(held, n)
    return runs, sequences


def pack_lengths(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = (), rows_a_bucket: int = 5_000) -> DataFrame:
    """Adds sequence_id and offset to rows that have a `length` from 1 to `capacity`. The rows are read twice; a caller
    that made them at some cost writes or checkpoints them first. Columns named sequence_id or offset are replaced; all other names
    are free. Ranks before a bucket come from a window of one row for each `rows_a_bucket` pieces, in one task for a length."""
    pieces = pieces.drop("sequence_id", "offset")
    order = order or tuple(pieces.columns)
    free = "_" * (1 + max((len(c) for c in pieces.columns), default=0))  # longer than any name
    bucket, n, before_, rank_ = (free + x for x in ("bucket", "n", "before", "rank"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan(counts, capacity)
    runs.sort()
    lengths, ranks = np.array([r[0] for r in runs], dtype=np.int64), np.array([r[1] for r in runs], dtype=np.int64)
    starts, first, offset = (lengths << 42) | ranks, np.array([r[2] for r in runs], dtype=np.int64), np.array([r[3] for r in runs], dtype=np.int64)
    buckets = max(1, -(-sum(counts.values()) // rows_a_bucket))
    pieces = pieces.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (
        pieces.groupBy("length", bucket).agg(F.count("*").alias(n))
        .select("length", bucket, (F.sum(n).over(W.partitionBy("length").orderBy(bucket)) - F.col(n)).alias(before_))
    )
    ranked = pieces.withColumn(rank_, F.row_number().over(W.partitionBy("length", bucket).orderBy(*order)))
    ranked = ranked.join(before, ["length", bucket]).withColumn(rank_, F.col(rank_) - 1 + F.col(before_)).drop(bucket, before_)
    names = [c for c in ranked.columns if c != rank_]

    def run(batches):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.schema.get_field_index(rank_)).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(starts, (length << 42) | rank, side="right") - 1
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.record_batch([*columns, pa.array(first[at] + rank - ranks[at]), pa.array(offset[at])], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != rank_)
    return ranked.mapInArrow(lean(run), f"{schema}, sequence_id long, offset long")


PIECES = "doc_id long, piece int, start long, length long"


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, closing: int = 1, digest: bool = False) -> DataFrame:
    """Tokens of all documents, each with a closing id, cut only where longer than `capacity`, packed into sequences:
    doc_id, piece, start, length, sequence_id, offset, and ids of the piece or (`digest`) their CRC-32."""

    def cut(keys: pa.Array, rows: list[np.ndarray], vocab) -> pa.RecordBatch:
        index, piece, start, length, ids = [], [], [], [], []
        for i, row in enumerate(rows):
            row = np.append(row, closing).astype(np.int32)
            for lo in range(0, len(row), capacity):
                part = row[lo : lo + capacity]
                index.append(i)
                piece.append(lo // capacity)
                start.append(lo)
                length.append(len(part))
                ids.append(zlib.crc32(part.astype("<u4").tobytes()) if digest else part)
        last = pa.array(ids, pa.int64() if digest else pa.list_(pa.int32()))
        return pa.record_batch([keys.take(pa.array(index)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), last], names=["doc_id", "piece", "start", "length", "ids_crc32" if digest else "ids"])

    with_checkpoint_dir(docs.sparkSession)
    pieces = encode(docs, path, then=cut, schema=f"{PIECES}, ids_crc32 long" if digest else f"{PIECES}, ids array<int>").checkpoint()
    return pack_lengths(pieces, capacity, ("doc_id", "piece", "ids_crc32" if digest else "ids"))
