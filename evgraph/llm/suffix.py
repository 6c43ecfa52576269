"""Removal of byte strings that occur more than once, through a sparse suffix array.

Of all suffixes only those at anchors are sorted. An anchor of a string of `length` bytes is the leftmost of its 64-byte
grams with the least rank (a short hash), so equal strings have equal anchors at equal places, and one anchor stands for a run of
strings that overlap: its context. Two strings can only be equal if their anchors' grams are.

1. A count-min sketch of anchor grams (see `substring.sketch`; it grows with the input and is never gathered) tells which anchors occur once:
   their strings do too. A sample of texts (SAMPLE bytes at most) gives leading tokens (16 bytes from the anchor on) for splitters.
2. The other anchors' suffixes are range-partitioned by leading tokens. Equal contexts of one batch travel once. Splitters
   never part equal tokens, so no equal pair straddles a boundary. An anchor that the sample shows to be hot is
   not kept together: each of its strings travels on its own, by the hash of all its bytes, and is compared there.
3. A bucket settles equal contexts at once. For anchors with several contexts it sorts the strings by a multikey quicksort
   over 8-byte characters (ties go on to the next character; a group is sorted only by characters that part it), which leaves exactly the equal ones.
4. Marks meet their documents by a hash of the row, and covered bytes are left out.

A null text is empty. A text shorter than `length` loses nothing. Texts of any size are worked on in pieces that overlap.
Rows that repeat, with the same id or not, are documents of their own, so copies remove each other's bytes. A null id stays
null. Columns other than id and text aren't read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import CHUNK, NO_ID, STEP, binary, byte_range_hashes, covered, eights, groups_for, joined, lean, longs, measure, pack, pieces, spread, unpack, utf8
from evgraph.llm.substring import by_group, dealt, marks_of, repeated, rows_of, sketch, with_marks

GRAM = 64
SLICE = 8 << 20
#: Bytes of text from which splitters are taken.
SAMPLE = 64 << 20
TOKEN = 16
#: Strings that one sorting step holds.
BLOCK = 1 << 16
#: For the ranks of grams: they only choose anchors, so what collides loses nothing.
_RANK = (np.uint64(0x9E3779B97F4A7C15), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def least_grams(data: np.ndarray, width: int, gram: int, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the leftmost least gram of `width` in a row isn't that of the place before, or that are in `heads` (sorted), and that gram.
    Grams are ranked by the upper bits of a 32-bit hash, whose lower ones are the place (17 and 15 for strings of 200 bytes)."""
    n = len(data) - gram - width + 2
    bits = (STEP + width).bit_length()  # of a place within a step
    place = np.arange(1 << bits, dtype=np.uint32)
    last = np.uint32(place[-1])
    words, at, anchors, before = eights(data), [], [], -1
    bounds = np.searchsorted(heads, np.arange(0, n + STEP, STEP)).tolist()
    for k, x in enumerate(range(0, n, STEP)):
        y = min(n, x + STEP)
        h = (words[x : y + width + gram - 9] * _RANK[0] >> np.uint64(32)).astype(np.uint32)
        size = 8
        while size < gram:  # the last one overlaps, if gram is no power of two
            step = min(size, gram - size)
            left = h[:-step] * _RANK[1]
            left ^= left >> np.uint32(15)
            left += h[step:]
            left *= _RANK[2]
            h, size = left, size + step
        h &= ~last
        h |= place[: len(h)]
        step = 1
        while step * 2 <= width:
            h = np.minimum(h[:-step], h[step:])
            step *= 2
        if width > step:
            h = np.minimum(h[: len(h) - (width - step)], h[width - step :])
        new = np.empty(y - x, dtype=bool)
        new[0] = x + int(h[0] & last) != before
        np.not_equal(h[1:], h[:-1], out=new[1:])
        new[heads[bounds[k] : bounds[k + 1]] - x] = True
        before = x + int(h[-1] & last)
        here = np.flatnonzero(new)
        at.append(here + x)
        anchors.append((h[here] & last).astype(np.int64) + x)
    return np.concatenate(at), np.concatenate(anchors)


def contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM):
    """For each anchor of each text: text, start and end of its context, the anchor, and two hashes of its gram."""
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for part in pieces(offsets, length - 1):
        base, top = part[0][1], part[-1][3]
        here = data[base:top]
        if len(here) < length:
            continue
        rows, lo, own, end = (np.array(x, dtype=np.int64) for x in zip(*part, strict=True))
        n = np.minimum(own, end - length + 1) - lo  # strings that start in each piece
        rows, lo, n = rows[n > 0], lo[n > 0] - base, n[n > 0]
        if not len(n):
            continue
        first, anchor = least_grams(here, length - gram + 1, gram, lo)
        of = np.searchsorted(lo, first, side="right") - 1
        inside = (of >= 0) & (first < (lo + n)[of])
        first, anchor, of = first[inside], anchor[inside], of[inside]
        last = np.minimum(np.append(first[1:], len(here)) - 1, (lo + n)[of] - 1)
        one, other = (byte_range_hashes(here, anchor, anchor + gram, kind) for kind in range(2))
        for x, y in zip(out, (rows[of], first + base, last + base + length, anchor + base, one, other), strict=True):
            x.append(y)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64 if i > 3 else np.int64) for i, x in enumerate(out)]


def string_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of byte ranges that are sorted by start; in steps of bounded size."""
    out = np.empty((2, len(starts)), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + CHUNK)))
        base = starts[lo]
        part = data[base : ends[lo:hi].max()]
        for kind in range(2):
            out[kind, lo:hi] = byte_range_hashes(part, starts[lo:hi] - base, ends[lo:hi] - base, kind)
        lo = hi
    return out[0], out[1]


def tokens_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 16 bytes from each place on (a gram is longer, so they exist)."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(TOKEN)]).view(f"S{TOKEN}").ravel()


def same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows together, and where groups start in it."""
    order = np.lexsort(columns[::-1])
    head = np.zeros(len(order), dtype=bool)
    if len(order):
        head[0] = True
        for c in columns:
            s = c[order]
            head[1:] |= s[1:] != s[:-1]
    return order, head


def equal_strings(text: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which strings (of `length` bytes at `starts`) equal another of their group. Multikey quicksort: sort by one 8-byte
    character, drop those that stand alone, go on with the next character among ties. Groups that agree in a character are in order already."""
    out = np.zeros(len(starts), dtype=bool)
    active, head = same(group)
    words = np.ndarray((max(0, len(text) - 7),), dtype="<u8", buffer=text, strides=(1,))
    at, mixed = 0, True
    while True:
        if mixed:
            tied = ~(head & np.append(head[1:], True))
            active, head = active[tied], head[tied]
            places = starts[active]
        if at >= length or not active.size:
            break
        word = words[places + min(at, length - 8)]
        other = np.flatnonzero((word[1:] != word[:-1]) & ~head[1:])
        mixed = other.size > 0
        if mixed:
            label = np.cumsum(head)
            some = np.zeros(label[-1] + 1, dtype=bool)
            some[label[other]] = True
            mine = np.flatnonzero(some[label])
            order = mine[np.lexsort((word[mine], label[mine]))]
            active[mine], word[mine] = active[order], word[order]
            head[1:] |= word[1:] != word[:-1]
        at += 8
    out[active] = True
    return out


def runs(owner: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of what strings at these places (sorted within an owner) cover."""
    if not len(owner):
        return owner, place, place
    cut = np.concatenate(([True], (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + 1)))
    return owner[cut], place[cut], place[np.append(np.flatnonzero(cut)[1:] - 1, len(place) - 1)] + length


def repeated_spans(texts: DataFrame, length: int, bits: int, splitters: np.ndarray, hot: np.ndarray, groups: int) -> DataFrame:
    """(group, marks): packed ranges (key, id, place, end) of strings that occur elsewhere."""
    answers = sketch(texts, lambda data, offsets: contexts(data, offsets, length)[4:], bits)
    buckets = len(splitters) + 1

    def send(left, right):
        column = left.column("text").combine_chunks()
        ids, keys = longs(left.column("id").combine_chunks()), longs(left.column("key").combine_chunks())
        out: list[tuple[int, int, bytes]] = []
        cut = list(slices(column, SLICE))
        found = [contexts(*utf8(column.slice(lo, hi - lo)), length) for lo, hi in cut]
        keep = repeated(tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64) for i in (4, 5)), bits, right)
        done = 0
        for (lo, hi), (doc, start, end, anchor, h1, _) in zip(cut, found, strict=True):
            data, offsets = utf8(column.slice(lo, hi - lo))
            at = np.flatnonzero(keep[done : done + len(doc)])
            done += len(doc)
            doc, start, end, anchor, h1 = doc[at], start[at], end[at], anchor[at], h1[at]
            local: list[tuple[np.ndarray, ...]] = []
            busy = np.isin(h1, hot)
            if busy.any():
                n = (end - start - length + 1)[busy]
                place, own = spread(start[busy], n), np.repeat(doc[busy], n)
                a, b = string_hashes(data, place, place + length)
                order, head = same(a, b)
                first = np.flatnonzero(head)
                count = np.diff(np.append(first, len(order)))
                many = np.zeros(len(order), dtype=bool)
                many[order] = np.repeat(count > 1, count)
                local.append(runs(own[many], place[many], length))
                one = order[first]
                bucket = (b[one] % np.uint64(buckets)).astype(np.int64)
                for s in np.unique(bucket).tolist():
                    mine = one[bucket == s]
                    docs_, index = np.unique(own[mine], return_inverse=True)
                    out.append((s, -2, pack(a=a[mine], b=b[mine], many=many[mine], doc=index.astype(np.int32), place=place[mine] - offsets[own[mine]], id=ids[docs_ + lo], key=keys[docs_ + lo])))
                doc, start, end, anchor, h1 = doc[~busy], start[~busy], end[~busy], anchor[~busy], h1[~busy]
            if len(doc):
                a, b = string_hashes(data, start, end)
                order, head = same(h1, a, b)
                first = np.flatnonzero(head)
                count = np.diff(np.append(first, len(order)))
                many = np.zeros(len(order), dtype=bool)
                many[order] = np.repeat(count > 1, count)
                local.append((doc[many], start[many], end[many]))
                one = np.sort(order[first])
                bucket = np.searchsorted(splitters, tokens_at(data, anchor[one]), side="right")
                for s in np.unique(bucket).tolist():
                    mine = one[bucket == s]
                    docs_, index = np.unique(doc[mine], return_inverse=True)
                    size = end[mine] - start[mine]
                    out.append((s, -1, pack(h=h1[mine], a=a[mine], b=b[mine], many=many[mine], rel=(anchor[mine] - start[mine]).astype(np.int32), size=size.astype(np.int32), doc=index.astype(np.int32), place=start[mine] - offsets[doc[mine]], id=ids[docs_ + lo], key=keys[docs_ + lo], text=data[spread(start[mine], size)])))
            if local:
                d, s, e = (np.concatenate(x) for x in zip(*local, strict=True))
                out += [(g % buckets, g, v) for g, v in by_group(["place"], keys[d + lo], groups, id=ids[d + lo], place=s - offsets[d], end=e - offsets[d])]
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), binary([x[2] for x in out])], names=["bucket", "group", "marks"])

    def settle(table):
        out, by_kind = [], {-1: [], -2: []}
        for group, value in zip(table.column("group").to_pylist(), table.column("marks"), strict=True):
            if group >= 0:
                out.append((group, value.as_py()))
            else:
                by_kind[group].append(unpack(value.as_py()))
        for kind, parts in by_kind.items():
            if parts:
                before = np.cumsum([0] + [len(p["id"]) for p in parts])
                doc = np.concatenate([p["doc"].astype(np.int64) + b for p, b in zip(parts, before, strict=False)])
                all_ = joined(parts)
                own, place, end = (settle_contexts if kind == -1 else settle_hot)(all_, doc, length)
                out += by_group(["place"], all_["key"][own], groups, id=all_["id"][own], place=place, end=end)
        return pa.table([pa.array([g for g, _ in out], pa.int32()), binary([v for _, v in out])], names=["group", "marks"])

    sent = texts.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(send, "bucket int, group int, marks binary")
    return sent.repartition(groups, "bucket").groupBy("bucket").applyInArrow(settle, "group int, marks binary")


def settle_hot(x: dict[str, np.ndarray], doc: np.ndarray, length: int):
    """Strings of hot anchors: equal by the two hashes of all their bytes."""
    order, head = same(x["a"], x["b"])
    count = np.diff(np.append(np.flatnonzero(head), len(order)))
    found = np.zeros(len(order), dtype=bool)
    found[order] = np.repeat(count > 1, count)
    at = np.flatnonzero(found & ~x["many"])
    at = at[np.lexsort((x["place"][at], doc[at]))]
    return runs(doc[at], x["place"][at], length)


def settle_contexts(x: dict[str, np.ndarray], doc: np.ndarray, length: int):
    """Contexts of a bucket: equal ones at once, strings of the others by sorting them."""
    order, head = same(x["h"], x["a"], x["b"])
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(order)))
    whole = np.zeros(len(order), dtype=bool)  # contexts that occur elsewhere as a whole
    whole[order] = np.repeat(count > 1, count)
    done = np.flatnonzero(whole & ~x["many"])
    out = [(doc[done], x["place"][done], x["place"][done] + x["size"][done])]
    rep = order[first]
    anchor = x["h"][rep]  # sorted
    edge = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(rep) else np.zeros(0, np.int64)
    n = np.diff(np.append(edge, len(rep)))
    rep, label = rep[np.repeat(n > 1, n)], np.repeat(np.arange(len(n)), n)[np.repeat(n > 1, n)]
    text_at = np.cumsum(x["size"].astype(np.int64)) - x["size"]
    strings = (x["size"][rep] - length + 1).astype(np.int64)
    total = np.cumsum(strings)
    lo = 0
    while lo < len(rep):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BLOCK, side="right"))
        hi = max(hi, lo + 1)
        hi = int(np.searchsorted(label, label[hi - 1], side="right"))  # all contexts of an anchor together
        own, k = rep[lo:hi], strings[lo:hi]
        at = spread(np.zeros(len(own), np.int64), k)
        group = np.repeat(label[lo:hi] - label[lo], k) * (1 << 20) + (np.repeat(x["rel"][own].astype(np.int64), k) - at)
        found = equal_strings(x["text"], np.repeat(text_at[own], k) + at, group, length)
        found &= ~np.repeat(whole[own] | x["many"][own], k)
        found = np.flatnonzero(found)
        which = np.repeat(own, k)[found]
        w, s, e = runs(which, x["place"][which] + at[found], length)
        out.append((doc[w], s, e))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def remove_repeated(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", cells: int = 8, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """`id, no_text, n_bytes, n_removed, starts, ends, kept` and the columns to carry as `c0`, `c1`, ...: each text without the bytes that a string of `length` bytes covers which
    also starts anywhere else, the removed ranges, and what is left (as bytes, for a character may be
    cut; or `as_text`, without characters that lost a byte)."""
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    # a row's own number isn't needed: rows of equal key are copies and lose the same bytes
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).isNull().alias("no_text"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    more = [f"c{i}" for i in range(len(carry))]
    docs = docs.select(F.coalesce("id", F.lit(int(NO_ID))).alias("id"), F.col("id").isNull().alias("no_id"), "no_text", "text", F.xxhash64("id", "text").alias("key"), *more)
    rows, size = measure(docs)
    anchors = max(1, size * 2 // (length - GRAM + 2))
    bits = max(16, int(np.ceil(np.log2(anchors * cells))))
    groups = groups_for(size)

    def sample(batches):
        for batch in batches:
            column = batch.column(0)
            for lo, hi in slices(column, 1 << 20):
                data, offsets = utf8(column.slice(lo, hi - lo))
                _, _, _, anchor, h, _ = contexts(data, offsets, length)
                take = np.arange(0, len(h), max(1, min(anchors, anchors * SAMPLE // max(1, size)) // 40_000))
                if len(take):
                    yield pa.record_batch([binary([pack(h=h[take], token=np.frombuffer(tokens_at(data, anchor[take]).tobytes(), dtype=np.uint8))])], names=["sample"])

    some = docs.where(F.pmod(F.col("key"), F.lit(max(1, size // SAMPLE))) == 0) if size > SAMPLE else docs
    seen = joined([unpack(bytes(r["sample"])) for r in some.select("text").mapInArrow(lean(sample), "sample binary").toLocalIterator()])
    splitters, hot = np.zeros(0, f"S{TOKEN}"), np.zeros(0, np.uint64)
    if seen and len(seen["h"]):
        tokens = np.sort(np.frombuffer(seen["token"].tobytes(), dtype=f"S{TOKEN}"))
        splitters = np.unique(tokens[np.linspace(0, len(tokens) - 1, groups + 1).astype(np.int64)[1:-1]])
        limit = max(8, len(tokens) // (4 * groups))
        hot = np.array([h for h, n in Counter(seen["h"].tolist()).items() if n >= limit], dtype=np.uint64)
    texts = dealt(docs, groups)
    marks = repeated_spans(texts, length, bits, splitters, hot, groups)

    def apply(left, right):
        ids, keys = longs(left.column("id").combine_chunks()), longs(left.column("key").combine_chunks())
        marks = marks_of(right)
        lo, hi = rows_of(keys, ids, marks)
        text = left.column("text").combine_chunks().cast(pa.large_string())
        sizes, removed, kept, starts, ends = [], [], [], [], []
        for a, b in slices(text, CHUNK):
            data, offsets = utf8(text.slice(a, b - a))
            for i in range(a, b):
                x, y = int(offsets[i - a]), int(offsets[i - a + 1])
                sizes.append(y - x)
                if hi[i] == lo[i]:
                    removed.append(0)
                    kept.append(data[x:y].tobytes())
                    starts.append([])
                    ends.append([])
                    continue
                gone = covered(marks["place"][lo[i] : hi[i]], marks["end"][lo[i] : hi[i]], y - x)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                removed.append(int(gone.sum()))
                kept.append(data[x:y][~gone].tobytes())
                starts.append(edges[::2].tolist())
                ends.append(edges[1::2].tolist())
        none = left.column("no_id").combine_chunks().to_numpy(zero_copy_only=False)
        longs_ = pa.list_(pa.int64())
        return pa.table([pa.array(ids, mask=none), left.column("no_text").combine_chunks(), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(starts, longs_), pa.array(ends, longs_), pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else binary(kept), *[left.column(c).combine_chunks() for c in more]], names=["id", "no_text", "n_bytes", "n_removed", "starts", "ends", "kept", *more])

    types = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)
    return with_marks(texts, marks, apply, f"id long, no_text boolean, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept {'string' if as_text else 'binary'}{types}")
