"""Removal of word windows that an earlier document holds, with a count-min prefilter.

1. Documents are dealt to groups of bounded size by a hash of the row. Each group counts its windows in a sketch of two hash rows whose
   cells saturate at two, and sends the cells it used to the shards that hold these cells. A shard merges the groups' parts and answers
   each group with a bit for each cell it sent. Merged counts are never below the true ones, so a window whose cells
   aren't both two or more occurs once and needs no further look.
2. A second pass over the same groups sends the windows estimated repeated, by a 96-bit hash, and groups them exactly. Before that each
   group settles what it can itself: of a window it holds in several documents only the smallest document's
   places travel, so a window that a third of all documents share sends one entry for each group.
3. Marks meet their documents in a third pass over the groups, and covered words are left out.

The sketch has four cells for each window, whatever the input, so the share of single windows that pass doesn't grow; it is never gathered or
broadcast. The exchange of the texts is used three times. A message is a group's cells of one shard, so groups times
shards messages travel, as blocks do in any shuffle; shards grow with the square root of the sketch until their memory is bounded.

Words are runs of bytes other than ASCII white space. A null or empty text has no words. Documents of fewer words than
a window lose nothing. A very long text is a group of its own and is worked on whole, at some 60 bytes for each of its words. A null id counts as
larger than any id. Rows with the same id never remove each other's words, whether they are copies or not. Columns other than id and
text aren't read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import CHUNK, binary, byte_range_hashes, covered, groups_for, joined, keyed, longs, measure, pack, unpack, utf8, window_hashes

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bits of the cells that a shard holds: fewest and most (two bytes a cell in memory).
SHARD_BITS = (22, 25)
SLICE = 4 << 20


def words_of(data: np.ndarray, offsets: np.ndarray, hashes: bool = True):
    """Start and end byte of each word, two hashes of it, and the first word of each text (one more at the end)."""
    space = SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    heads = offsets[:-1][(offsets[:-1] < offsets[1:])]
    start[heads] = ~space[heads]
    edges = np.flatnonzero(start | space)
    word = start[edges]
    ends = np.append(edges[1:], len(data))[word]
    starts = edges[word]
    first = np.searchsorted(starts, offsets)
    if not hashes:
        return starts, ends, None, first
    found = [np.empty(len(starts), dtype=np.uint64) for _ in range(2)]
    lo = 0
    while lo < len(starts):  # in steps, so that a long text needs no arrays of its own size
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, side="right")))
        part = data[starts[lo] : ends[hi - 1]]
        for kind, out in enumerate(found):
            out[lo:hi] = byte_range_hashes(part, starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo], kind)
        lo = hi
    return starts, ends, found, first


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int):
    """Of each window of `size` words: text, first word (from 0), and two hashes."""
    _, _, found, first = words_of(data, offsets)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n), dtype=np.int32), np.maximum(0, n - size + 1))
    at = np.flatnonzero(np.arange(len(found[0])) + size <= np.repeat(first[1:], n))
    out = [window_hashes(words, size, kind)[at] for kind, words in enumerate(found)]
    return text, (at - first[text]).astype(np.int32), *out


def dealt(docs: DataFrame, groups: int) -> DataFrame:
    """Documents in groups of about GROUP_BYTES of text; passes over the result use one exchange."""
    return docs.withColumn("group", F.pmod(F.col("key"), F.lit(groups)).cast("int")).repartition(groups, "group")


def shard_bits(bits: int) -> int:
    """Bits of a shard's cells, for a sketch of `bits`."""
    return min(bits, int(np.clip(SHARD_BITS[0] + (bits - 29) // 2, *SHARD_BITS)))


def cells_sent(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted different cells as steps of the width that suits them (larger ones apart), and a bit for those used twice."""
    step = np.diff(cells, prepend=np.int64(0))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32) if t is np.uint32 or np.count_nonzero(step >= np.iinfo(t).max) * 16 <= len(step))
    most = np.iinfo(kind).max
    far = step[step >= most].astype(np.uint32) if kind is not np.uint32 else np.zeros(0, np.uint32)
    head = np.array([np.dtype(kind).itemsize, len(step), len(far)], dtype=np.uint32)
    return head.tobytes() + np.minimum(step, most).astype(kind).tobytes() + far.tobytes() + np.packbits(twice).tobytes()


def cells_got(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    width, n, more = (int(x) for x in np.frombuffer(value, np.uint32, 3))
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[width]
    step = np.frombuffer(value, kind, n, 12).astype(np.int64)
    if more:
        step[step == np.iinfo(kind).max] = np.frombuffer(value[12 + n * width : 12 + n * width + 4 * more], np.uint32)
    twice = np.unpackbits(np.frombuffer(value, np.uint8, -1, 12 + n * width + 4 * more), count=n).view(bool)
    return np.cumsum(step), twice


def sketch(texts: DataFrame, hashes_of, bits: int) -> DataFrame:
    """(group, shard, bits): for each group of `dealt` documents and each shard, a bit for each of the group's cells there, in
    order: whether it holds two or more. `hashes_of(data, offsets)` gives two hashes of each thing that is counted."""
    own = shard_bits(bits)
    bounds = np.arange(0, (1 << (bits - own)) + 1, dtype=np.uint64) << np.uint64(own)

    def count(key, table):
        held: tuple[list, list] = ([], [])
        column = table.column("text").combine_chunks()
        for lo, hi in slices(column, SLICE):
            for out, h in zip(held, hashes_of(*utf8(column.slice(lo, hi - lo))), strict=True):
                out.append(h >> np.uint64(64 - bits))
        shards, values = [], []
        for row, parts in enumerate(held):
            used = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
            new = np.concatenate(([True], used[1:] != used[:-1])) if used.size else np.zeros(0, bool)
            many = np.diff(np.append(np.flatnonzero(new), len(used))) > 1
            used = used[new]
            at = np.searchsorted(used, bounds)
            for s in np.flatnonzero(at[1:] > at[:-1]).tolist():
                part = slice(at[s], at[s + 1])
                shards.append(2 * s + row)
                values.append(cells_sent((used[part] - bounds[s]).astype(np.int64), many[part]))
        return pa.table([pa.array([key[0].as_py()] * len(shards), pa.int32()), pa.array(shards, pa.int32()), binary(values)], names=["group", "shard", "cells"])

    def merge(table):
        once, twice = np.zeros(1 << own, dtype=bool), np.zeros(1 << own, dtype=bool)
        for value in table.column("cells"):
            cells, many = cells_got(value.as_py())
            twice[cells[many | once[cells]]] = True
            once[cells] = True
        out = [np.packbits(twice[cells_got(value.as_py())[0]]).tobytes() for value in table.column("cells")]
        return pa.table([table.column("group"), table.column("shard"), binary(out)], names=["group", "shard", "bits"])

    parts = texts.groupBy("group").applyInArrow(count, "group int, shard int, cells binary")
    return parts.groupBy("shard").applyInArrow(merge, "group int, shard int, bits binary")


def repeated(hashes: tuple[np.ndarray, np.ndarray], bits: int, answers: pa.Table) -> np.ndarray:
    """Which things of a group may occur twice, by the answers to its cells; `hashes` as they were counted."""
    held = {s: np.frombuffer(v, np.uint8) for s, v in zip(answers.column("shard").to_pylist(), answers.column("bits").to_pylist(), strict=True)}
    out = np.ones(len(hashes[0]), dtype=bool)
    bounds = np.arange(0, (1 << (bits - shard_bits(bits))) + 1, dtype=np.uint64) << np.uint64(shard_bits(bits))
    for row, h in enumerate(hashes):
        cells = h >> np.uint64(64 - bits)
        order = np.argsort(cells)
        cells = cells[order]
        new = np.concatenate(([True], cells[1:] != cells[:-1])) if cells.size else np.zeros(0, bool)
        at = np.searchsorted(cells[new], bounds)
        said = [np.unpackbits(held[2 * s + row], count=int(at[s + 1] - at[s])) for s in np.flatnonzero(at[1:] > at[:-1]).tolist()]
        if said:
            out[order] &= np.concatenate(said).view(bool)[np.cumsum(new) - 1]
    return out


def small(values: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds all values."""
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def by_group(names: list[str], key: np.ndarray, groups: int, **columns: np.ndarray):
    """Rows (group, packed places) of marks, sorted by document."""
    if not len(key):
        return
    group = (key % groups).astype(np.int64)
    order = np.lexsort((columns[names[0]], key, group))
    group, key = group[order], key[order]
    columns = {k: v[order] for k, v in columns.items()}
    cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(group)], strict=True):
        yield int(group[lo]), pack(key=key[lo:hi], **{k: v[lo:hi] for k, v in columns.items()})


def repeated_windows(texts: DataFrame, size: int, bits: int, groups: int) -> DataFrame:
    """(group, marks): packed places (key, id, first word) of windows that a document of smaller id holds too."""
    answers = sketch(texts, lambda data, offsets: windows_of(data, offsets, size)[2:], bits)

    def send(left, right):
        out: list[tuple[int, int, bytes]] = []
        column = left.column("text").combine_chunks()
        ids, keys = longs(left.column("id").combine_chunks()), longs(left.column("key").combine_chunks())
        parts = []
        for lo, hi in slices(column, SLICE):
            text, place, h1, h2 = windows_of(*utf8(column.slice(lo, hi - lo)), size)
            parts.append({"h": h1, "g": h2, "doc": text + np.int32(lo), "place": place})
        all_ = joined(parts)
        if all_ and len(all_["h"]):
            at = np.flatnonzero(repeated((all_["h"], all_["g"]), bits, right))
            all_ = {k: v[at] for k, v in all_.items()}
            all_["g"] = (all_["g"] >> np.uint64(32)).astype(np.uint32)
            later = after_first(all_, ids[all_["doc"]])
            mine = all_["doc"][later]
            out += [(g % groups, g, v) for g, v in by_group(["place"], keys[mine], groups, id=ids[mine], place=all_["place"][later])]
            rest = {k: v[~later] for k, v in all_.items()}
            shard = (rest["h"] % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((rest["place"], rest["doc"], shard))
            cut = np.searchsorted(shard[order], np.arange(groups + 1))
            for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                own = order[cut[s] : cut[s + 1]]
                docs_, index = np.unique(rest["doc"][own], return_inverse=True)
                place = rest["place"][own]  # rises within a document: its steps are small
                step = np.where(np.diff(index, prepend=-1) > 0, place, np.diff(place, prepend=0))
                out.append((s, -1, pack(h=rest["h"][own], g=rest["g"][own], doc=small(np.diff(index, prepend=0)), place=small(step), id=ids[docs_], key=keys[docs_])))
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), binary([x[2] for x in out])], names=["shard", "group", "marks"])

    def settle(table):
        out = []
        parts = []
        for group, value in zip(table.column("group").to_pylist(), table.column("marks"), strict=True):
            if group >= 0:
                out.append((group, value.as_py()))
            else:
                parts.append(unpack(value.as_py()))
        if parts:
            before = np.cumsum([0] + [len(p["id"]) for p in parts])
            doc = np.concatenate([np.cumsum(p["doc"].astype(np.int64)) + b for p, b in zip(parts, before, strict=False)])
            all_ = {k: np.concatenate([p[k] for p in parts]) for k in ("h", "g")}
            step = np.concatenate([p["place"] for p in parts]).astype(np.int64)
            sums, head = np.cumsum(step), np.concatenate(([True], doc[1:] != doc[:-1]))
            all_["place"] = (sums - np.repeat((sums - step)[head], np.diff(np.append(np.flatnonzero(head), len(doc))))).astype(np.int32)
            ids, keys = (np.concatenate([p[k] for p in parts]) for k in ("id", "key"))
            later = after_first(all_, ids[doc])
            doc = doc[later]
            out += by_group(["place"], keys[doc], groups, id=ids[doc], place=all_["place"][later])
        return pa.table([pa.array([g for g, _ in out], pa.int32()), binary([v for _, v in out])], names=["group", "marks"])

    sent = texts.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(send, "shard int, group int, marks binary")
    return sent.repartition(groups, "shard").groupBy("shard").applyInArrow(settle, "group int, marks binary")


def after_first(windows: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Which windows occur in a document of smaller id."""
    order = np.lexsort((ids, windows["g"], windows["h"]))
    h, g, own = windows["h"][order], windows["g"][order], ids[order]
    head = np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
    least = own[np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))]
    out = np.empty(len(h), dtype=bool)
    out[order] = own > least
    return out


def with_marks(texts: DataFrame, marks: DataFrame, apply, schema: str) -> DataFrame:
    """Brings each group of documents and its marks together."""
    return texts.groupBy("group").cogroup(marks.groupBy("group")).applyInArrow(apply, schema)


def marks_of(table: pa.Table) -> dict[str, np.ndarray]:
    return joined([unpack(v.as_py()) for v in table.column("marks")])


def rows_of(keys: np.ndarray, ids: np.ndarray, marks: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each document of the group, the range of its marks; sorts the marks in place by (key, id)."""
    if not marks:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    order = np.lexsort((marks["id"], marks["key"]))
    for k in marks:
        marks[k] = marks[k][order]
    pair = np.rec.fromarrays([marks["key"], marks["id"]])
    new = np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    index = {(k, i): (lo, hi) for k, i, lo, hi in zip(marks["key"][at].tolist(), marks["id"][at].tolist(), at.tolist(), [*at[1:].tolist(), len(pair)], strict=True)}
    found = [index.get(x, (0, 0)) for x in zip(keys.tolist(), ids.tolist(), strict=True)]
    return np.array([f[0] for f in found], dtype=np.int64), np.array([f[1] for f in found], dtype=np.int64)


def remove_repeated_windows(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", cells: int = 4) -> DataFrame:
    """`id, n_words, n_removed, kept`: each document without the words that a window of an earlier document covers. The sketch
    has `cells` cells for each window (of six-byte words)."""
    docs = keyed(docs, id_col, text_col)
    rows, size = measure(docs)
    bits = max(16, int(np.ceil(np.log2(max(1, size // 6) * cells))))
    groups = groups_for(size)
    texts = dealt(docs, groups)
    marks = repeated_windows(texts, window, bits, groups)

    def apply(left, right):
        ids, keys, none = longs(left.column("id").combine_chunks()), longs(left.column("key").combine_chunks()), left.column("no_id").combine_chunks()
        marks = marks_of(right)
        lo, hi = rows_of(keys, ids, marks)
        out, text = [], left.column("text").combine_chunks()
        text = text.cast(pa.large_string())
        for a, b in slices(text, CHUNK):
            data, offsets = utf8(text.slice(a, b - a))
            starts, ends, _, first = words_of(data, offsets, hashes=False)
            n = hi[a:b] - lo[a:b]
            at = np.repeat(first[:-1], n) + (marks["place"][np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if n.sum() else np.zeros(0, np.int64))
            gone = covered(at, at + window, len(starts))
            kept = np.flatnonzero(~gone)
            sizes = ends[kept] - starts[kept] + 1  # with the space that follows
            place = np.cumsum(sizes) - sizes
            index = np.repeat(starts[kept] - place, sizes) + np.arange(sizes.sum())
            joined_ = np.append(data, np.uint8(32))[index]
            joined_[place + sizes - 1] = 32
            bounds = np.append(place, sizes.sum())[np.searchsorted(kept, first)]
            raw = joined_.tobytes()
            removed = np.concatenate(([0], np.cumsum(gone)))[first]
            out.append((ids[a:b], np.diff(first), np.diff(removed), [raw[x : max(x, y - 1)] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]))
        column = pa.array(ids, mask=none.to_numpy(zero_copy_only=False))
        return pa.table([column, pa.array(np.concatenate([o[1] for o in out]) if out else [], pa.int64()), pa.array(np.concatenate([o[2] for o in out]) if out else [], pa.int64()), pa.array([x for o in out for x in o[3]], pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])

    return with_marks(texts, marks, apply, "id long, n_words long, n_removed long, kept string")
