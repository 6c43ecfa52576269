"""Helpers that several operators of this subpackage share.

Operators that work on bytes or words run inside Spark tasks on Arrow batches. Batches are cut into
chunks of bounded size, so that a worker's memory doesn't depend on the batch or on one long text.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes or characters that one numpy step works on.
CHUNK = 1 << 19
#: Hashes that one step of a hash computation holds, so that they stay in a core's cache.
STEP = 1 << 14
#: Bytes of text that one group of documents holds on average.
GROUP_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


def _libc():
    return ctypes.CDLL("libc.so.6") if sys.platform == "linux" else None


# Spark reuses its Python workers, so memory that one frees should go back at once: in a worker, which imports this within a task,
# arrays of 1 MB and more get pages of their own. The driver's process is left as it is.
if TaskContext.get() is not None:
    with contextlib.suppress(OSError, AttributeError):
        if _libc():
            _libc().mallopt(-3, 1 << 20)


def lean(run):
    """For a function over a task's batches: gives memory back when the task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                if _libc():
                    _libc().malloc_trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Only where the session names none (tests) is one made, and only in local mode: on a
    cluster a folder of the driver is no use to executors."""
    from evgraph.operators.components import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    import uuid

    return f"{with_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- hashes
#
# Hashes of runs are built by doubling: the hash of 2w places mixes those of its two halves, and every step multiplies and
# shifts, so no structure of a text (periods, Thue-Morse words) makes two runs meet. A run of n places, w <= n < 2w for
# a power w, is known by the hashes of its first and its last w places and by n.

_U = np.uint64
_SEED = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))
_LEFT = (_U(0xC2B2AE3D27D4EB4F), _U(0xA0761D6478BD642F))
_BOTH = (_U(0xD6E8FEB86659FD93), _U(0xE7037ED1A0B428DB))
_SIZE = _U(0x2545F4914F6CDD1D)
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=_U)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place)."""
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xA0761D6478BD642F)
    h ^= h >> _U(32)
    return h


def _seeded(codes: np.ndarray, kind: int) -> np.ndarray:
    h = codes * _SEED[kind]
    h ^= h >> _U(31)
    return h


def _both(left: np.ndarray, right: np.ndarray, kind: int) -> np.ndarray:
    h = left * _LEFT[kind]
    h ^= h >> _U(32)
    h += right
    h *= _BOTH[kind]
    h ^= h >> _U(29)
    return h


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def _windows(h: np.ndarray, width: int, size: int, kind: int) -> np.ndarray:
    while width * 2 <= size:
        h = _both(h[:-width], h[width:], kind)
        width *= 2
    if width < size:
        h = _both(h[: len(h) - (size - width)], h[size - width :], kind)
    return mix(h)


def _stepped(codes: np.ndarray, n: int, width: int, size: int, kind: int) -> np.ndarray:
    """`_windows` of n windows in steps that stay in the cache."""
    out = np.empty(max(0, n), dtype=_U)
    for lo in range(0, n, STEP):
        hi = min(n, lo + STEP)
        out[lo:hi] = _windows(_seeded(codes[lo : hi + size - width], kind), width, size, kind)
    return out


def window_hashes(codes: np.ndarray, size: int, kind: int = 0) -> np.ndarray:
    """Hash of each run of `size` 64-bit codes; the two kinds are independent."""
    return _stepped(codes, len(codes) - size + 1, 1, size, kind)


def range_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of ranges of an array of 64-bit codes; starts rise."""
    out = np.zeros(len(start), dtype=_U)
    lo = 0
    while lo < len(start):
        base = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(start, base + STEP)))
        s, e = start[lo:hi] - base, end[lo:hi] - base
        n = e - s
        width, h, held = 1, _seeded(codes[base : base + int(e.max())], kind), out[lo:hi]
        while True:
            at = np.flatnonzero((n >= width) & (n < 2 * width))
            if at.size:
                held[at] = _both(h[s[at]], h[e[at] - width], kind)
            if n.max() < 2 * width:
                break
            h = _both(h[:-width], h[width:], kind)
            width *= 2
        lo = hi
    out += (end - start).astype(_U) * _SIZE
    return mix(out)


def _gathered(words: np.ndarray, start: np.ndarray, end: np.ndarray, width: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of the first and last `width` bytes of ranges, from their own words alone: for ranges that overlap little."""

    def tree(place: np.ndarray, w: int) -> np.ndarray:
        h = _seeded(words[np.arange(0, w, 8)[:, None] + place], kind)
        while len(h) > 1:
            h = _both(h[::2], h[1::2], kind)
        return h[0]

    out = np.empty(len(start), dtype=_U)
    for w in np.unique(width).tolist():
        of_width = np.flatnonzero(width == w)
        step = max(1, STEP * 8 // w)
        for lo in range(0, len(of_width), step):
            at = of_width[lo : lo + step]
            s, e = start[at], end[at] - w
            left = tree(s, w)
            out[at] = _both(left, left if (s == e).all() else tree(e, w), kind)
    return out


def _doubled(data: np.ndarray, s: np.ndarray, size: np.ndarray, kind: int) -> np.ndarray:
    """The same from the hashes at all places: for ranges that overlap much."""
    if size.sum() * 2 < len(data):  # long ranges are few: their bytes alone
        data = data[spread(s, size)]
        s = np.cumsum(size) - size
    width, h = 8, _seeded(eights(data)[: len(data) - 7], kind)
    held = np.zeros(len(s), dtype=_U)
    while True:
        fit = np.flatnonzero((size >= width) & (size < 2 * width))
        if fit.size:
            held[fit] = _both(h[s[fit]], h[s[fit] + size[fit] - width], kind)
        if size.max() < 2 * width:
            return held
        h = _both(h[:-width], h[width:], kind)
        width *= 2


def byte_range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of ranges of bytes."""
    n = end - start
    out = np.zeros(len(start), dtype=_U)
    words = eights(data)
    at = np.flatnonzero(n <= 8)
    first = _seeded(words[start[at]] & _MASK[n[at]], kind)
    out[at] = _both(first, first, kind)
    long = np.flatnonzero(n > 16)
    at = np.flatnonzero((n > 8) & (n <= 16))
    out[at] = _both(_seeded(words[start[at]], kind), _seeded(words[end[at] - 8], kind), kind)
    if long.size:
        s, size = start[long], n[long]
        power = np.frexp(size)[1] - 1
        width = np.int64(1) << power.astype(np.int64)
        if int(width.sum()) // 4 <= min(len(data), 2 * int(size.sum())) * (int(power.max()) - 2):
            out[long] = _gathered(words, s, s + size, width, kind)
        else:
            out[long] = _doubled(data, s, size, kind)
    out += n.astype(_U) * _SIZE
    return mix(out)


# ---------------------------------------------------------------- Arrow columns


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the int64 offset of each; a null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def longs(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def pieces(offsets: np.ndarray, overlap: int, size: int = CHUNK):
    """Cuts texts into chunks: yields lists of (row, start, own end, end). A text longer than a chunk is cut;
    each piece then reads up to `overlap` bytes beyond its own end."""
    out, held = [], 0
    for row in range(len(offsets) - 1):
        lo, hi = int(offsets[row]), int(offsets[row + 1])
        if held and held + hi - lo > size:
            yield out
            out, held = [], 0
        while hi - lo > size:
            yield [(row, lo, lo + size, min(hi, lo + size + overlap))]
            lo += size
        out.append((row, lo, hi, hi))
        held += hi - lo
    if out:
        yield out


def binary(values: list) -> pa.Array:
    return pa.array(values, type=pa.binary())


# ---------------------------------------------------------------- packed arrays


_LZ4 = pa.Codec("lz4")


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: a line that names them (a few bytes for each), and their contents from multiples of eight bytes on."""
    names = sorted(arrays)
    head = ",".join(f"{k}:{arrays[k].dtype.str[1:]}:{len(arrays[k])}" for k in names).encode() + b"\n"
    body = b"".join(x for k in names for x in (arrays[k].tobytes(), bytes(-arrays[k].nbytes % 8)))
    return head + (_LZ4.compress(body, asbytes=True) if body else b"")


def unpack(value: bytes) -> dict[str, np.ndarray]:
    end = value.index(b"\n")
    fields = [(k, np.dtype(kind), int(n)) for k, kind, n in (x.split(":") for x in value[:end].decode().split(",") if x)]
    sizes = [kind.itemsize * n for _, kind, n in fields]
    total = sum(-(-x // 8) * 8 for x in sizes)
    raw = _LZ4.decompress(memoryview(value)[end + 1 :], decompressed_size=total) if total else b""
    out, at = {}, 0
    for (k, kind, n), size in zip(fields, sizes, strict=True):
        out[k] = np.frombuffer(raw, dtype=kind, count=n, offset=at) if n else np.zeros(0, kind)
        at += -(-size // 8) * 8
    return out


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


# ---------------------------------------------------------------- documents by key


def row_key(id_col: Column, text_col: Column) -> Column:
    """The key of a row: rows of equal key have the same id (or none) and text."""
    return F.xxhash64(id_col.cast("long"), F.coalesce(text_col, F.lit("")))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id (a null id counts as larger than any), text (null: empty), and a key of the row: rows of equal key are copies."""
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return out.select(F.coalesce("id", F.lit(int(NO_ID))).alias("id"), F.col("id").isNull().alias("no_id"), "text", row_key(F.col("id"), F.col("text")).alias("key"))


def measure(docs: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of text."""
    r = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def groups_for(total_bytes: int) -> int:
    return max(8, -(-total_bytes // GROUP_BYTES))


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places lie in any of the ranges."""
    step = np.zeros(size + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0
