"""BPE encoding and decoding through an index of pair occurrences.

Each task cuts its texts into words, keeps every distinct word of a slice once, and lays their symbols in
one array. The index maps each mergeable pair (by its rank) to all places where it occurs. The lowest active
rank is applied at all its places at once; the pairs that this makes or breaks are the only lists touched.

The vocabulary is a `tokenizers` file of BPE over byte-level words with an end-of-word suffix; it is read on the
executors from a path and never copied. Results equal the library's `encode(text, add_special_tokens=False)`
and `decode(ids, skip_special_tokens=False)`.

Null texts are empty and give no ids. Repeated rows give repeated results. Columns of the input other than the
id and the text are not read, so extra columns can't clash. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evgraph.llm.common import lean, mix, range_hashes, spread

#: Characters in one numpy step, and bytes of text whose distinct words are encoded together.
STEP_CHARS = 1 << 19
SLICE_BYTES = 12 << 20
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def newer() -> dict[str, int]:
    """Letters (1) and numbers (2) that the tokenizer's Unicode tables have and this Python's don't, so that ids don't depend on the
    Python version of an executor."""
    from tokenizers import Regex, pre_tokenizers

    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    found = {}
    for kind, pattern in ((1, r"\p{L}"), (2, r"\p{N}")):
        found |= {c: kind for piece, _ in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(unknown) for c in piece}
    return found


@functools.cache
def newer_pattern() -> re.Pattern:
    points = np.array(sorted(map(ord, newer())), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(points) > 1) + 1
    runs = "".join(f"\\U{p[0]:08x}-\\U{p[-1]:08x}" for p in np.split(points, cuts) if len(p))
    return re.compile(f"[{runs}]" if runs else "(?!)")


@functools.cache
def char_classes() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: 0 space, 1 letter, 2 number, 3 other; and a 64-bit code."""
    kinds = {"L": 1, "N": 2}
    classes = np.frombuffer(bytes(kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(0x110000)), dtype=np.uint8).copy()
    classes[[ord(c) for c in newer()]] = list(newer().values())
    classes[SPACES] = 0
    return classes, mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


class Vocabulary:
    """Ranks and symbols of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        ids, merges = held["model"]["vocab"], held["model"]["merges"]
        self.end = held["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # bytes as printable characters: those that print keep their own code point, the others follow from 256 on
        prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        chars = [chr(b if b in prints else next(hidden)) for b in range(256)]
        self.inner = np.array([ids[c] for c in chars], dtype=np.int32)
        self.last = np.array([ids[c + self.end] for c in chars], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int32)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int32)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        first = np.full(len(self.tokens), len(pairs), dtype=np.int64)
        np.minimum.at(first, self.left, np.arange(len(pairs)))
        np.minimum.at(first, self.right, np.arange(len(pairs)))
        #: merges whose symbol takes part in an earlier rank: only one place of a word at a time then
        self.early = first[self.made] <= np.arange(len(pairs))
        self._table()

    def _table(self) -> None:
        """Open addressing from a pair to its rank."""
        keys = (self.left.astype(np.uint64) << np.uint64(20)) | self.right.astype(np.uint64)
        self.bits = max(10, int(len(keys) * 5).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.ranks = np.full(size, -1, dtype=np.int32)
        slots = self._slot(keys)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots.tolist(), strict=True)):
            while self.ranks[slot] >= 0 and self.keys[slot] != key:
                slot = (slot + 1) & (size - 1)
            if self.ranks[slot] < 0:
                self.keys[slot], self.ranks[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it isn't one; negative symbols form no pairs."""
        keys = (a.astype(np.uint64) << np.uint64(20)) | (b.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(keys)
        out = self.ranks[slot]
        open_ = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        out[open_] = -1
        at = slot[open_]
        while open_.size:
            at = (at + 1) & (len(self.keys) - 1)
            found = self.ranks[at]
            hit = (self.keys[at] == keys[open_]) & (found >= 0)
            out[open_[hit]] = found[hit]
            more = ~hit & (found >= 0)
            open_, at = open_[more], at[more]
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words one after another, and where each word's begin (one more at the end)."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(data)
        sym = np.empty(n + 1, dtype=np.int32)
        sym[:n] = self.inner[data]
        ends = np.cumsum(sizes)
        sym[ends - 1] = self.last[data[ends - 1]]
        sym[n] = -1
        nxt = np.arange(1, n + 2, dtype=np.int32)
        nxt[ends - 1] = n
        prv = np.arange(-1, n, dtype=np.int32)
        prv[ends - sizes] = n
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes) if self.early.any() else None
        active: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, part in zip(ranks[np.concatenate(([0], cut))].tolist(), np.split(places, cut), strict=True):
                if rank in active:
                    active[rank].append(part)
                else:
                    active[rank] = [part]
                    heapq.heappush(heap, rank)

        first = self.rank(sym[:-1], sym[nxt[:-1]])
        first[sym[nxt[:-1]] < 0] = -1
        at = np.flatnonzero(first >= 0).astype(np.int32)
        if at.size:
            add(at, first[at])
        while heap:
            rank = heapq.heappop(heap)
            parts = active.pop(rank)
            p = parts[0] if len(parts) == 1 else np.concatenate(parts)
            a, b, made = self.left[rank], self.right[rank], self.made[rank]
            p = p[(sym[p] == a) & (sym[nxt[p]] == b)]
            if not p.size:
                continue
            if len(p) > 1:
                p = np.sort(p)
                p = p[np.concatenate(([True], p[1:] != p[:-1]))]
                if a == b:  # in a run of equal symbols every other place merges
                    at = np.arange(len(p))
                    head = np.concatenate(([True], nxt[p[:-1]] != p[1:]))
                    p = p[(at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0]
                if self.early[rank]:
                    lead = np.concatenate(([True], word[p[1:]] != word[p[:-1]]))
                    if not lead.all():
                        active[rank] = [p[~lead]]
                        heapq.heappush(heap, rank)
                        p = p[lead]
            q = nxt[p]
            after = nxt[q]
            sym[q] = -1
            sym[p] = made
            nxt[p] = after
            prv[after] = p
            before = prv[p]
            places = np.concatenate((before, p))
            x, y = sym[places], np.concatenate((np.full(len(p), made, dtype=np.int32), sym[after]))
            ok = (x >= 0) & (y >= 0)
            places, x, y = places[ok], x[ok], y[ok]
            if places.size:
                ranks = self.rank(x, y)
                ok = ranks >= 0
                if ok.any():
                    add(places[ok], ranks[ok])
        alive = np.flatnonzero(sym[:n] >= 0)
        bounds = np.searchsorted(alive, np.concatenate(([0], ends)))
        return sym[alive], bounds

    def decode(self, ids: list[int]) -> str:
        """Tokens one space apart, as the library does where the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def normalised(text: str) -> str:
    """Composed and lower-cased one character at a time (a final sigma stays a plain one)."""
    if text.isascii():
        return text.lower()
    if newer_pattern().search(text):  # characters that this Python can't lower
        from tokenizers import normalizers

        return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def cut_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the code points. Words are contractions, runs of letters, single numbers and
    runs of anything else but space."""
    classes, _ = char_classes()
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kind = classes[points]
    start = kind != 0
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    for at in np.flatnonzero((points == 39) & start):
        tail = text[at + 1 : at + 3]
        size = 2 if tail[:1] in ("s", "t", "m", "d") else 3 if tail in ("re", "ve", "ll") else 0
        if size:
            start[at + 1] = False
            if at + size < len(kind) and kind[at + size] == 1:
                start[at + size] = True
    edges = np.flatnonzero(start | (kind == 0))
    of = start[edges]
    ends = np.append(edges[1:], len(points))
    return edges[of], ends[of], points


class Words:
    """Distinct words of a slice of texts. Hashes only bring equal words together; equality is that of their characters."""

    def __init__(self):
        self.held: list[list[str]] = []

    def add(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where each word of the text starts, and its number among the distinct words of this text."""
        start, end, points = cut_words(text)
        number, keys = pd.factorize(range_hashes(char_classes()[1][points], start, end))
        first = np.empty(len(keys), dtype=np.int64)
        first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        size, other = end - start, first[number]
        same = (size == size[other]).all() and (points[spread(start, size)] == points[spread(start[other], size)]).all()
        if not same:  # different words of one hash
            seen: dict[str, int] = {}
            number = np.array([seen.setdefault(text[s:e], len(seen)) for s, e in zip(start.tolist(), end.tolist(), strict=True)], dtype=np.int64)
            first = np.unique(number, return_index=True)[1]
        self.held.append([text[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)])
        return start, number

    def distinct(self) -> tuple[list[bytes], list[np.ndarray]]:
        """All distinct words, and for each text that was added their numbers by the text's own."""
        seen: dict[str, int] = {}
        numbers = [np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) for words in self.held]
        return [w.encode() for w in seen], numbers


def encode_texts(texts: list[str], vocab: Vocabulary) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, its ids) of all texts, in order."""
    seen, steps = Words(), []
    parts, marks, specials, size = [], [], [], 0

    def close() -> None:
        start, number = seen.add("\n".join(parts))
        steps.append((start.astype(np.int32), number.astype(np.int32), list(marks), list(specials)))

    for i, text in enumerate(texts):
        marks.append((i, size))
        found = list(vocab.split.finditer(text)) if vocab.split and "<" in text else []
        lo = 0
        for m in [*found, None]:
            part = normalised(text[lo : m.start() if m else len(text)])
            while True:  # a long text is cut where a word can't be
                cut = len(part) if len(part) <= STEP_CHARS else max(part.rfind("\n", 1, STEP_CHARS), part.rfind(" ", 1, STEP_CHARS))
                cut = len(part) if cut <= 0 else cut
                parts.append(part[:cut])
                size += cut + 1
                part = part[cut:]
                if size > STEP_CHARS:
                    close()
                    parts, marks, specials, size = [], [(i, 0)], [], 0
                if not part:
                    break
            if m:
                specials.append((size, vocab.special[m.group()]))
                lo = m.end()
    close()
    words, numbers = seen.distinct()
    ids, bounds = vocab.encode_words(words) if words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
    lengths = np.diff(bounds)
    carry: tuple[int, list[np.ndarray]] | None = None
    for (start, number, marks, specials), own in zip(steps, numbers, strict=True):
        number = own[number]
        n = lengths[number]
        total = np.concatenate(([0], np.cumsum(n)))
        out = ids[np.repeat(bounds[number] - total[:-1], n) + np.arange(total[-1])] if len(n) else ids[:0]
        if specials:
            at = total[np.searchsorted(start, [s for s, _ in specials])]
            out = np.insert(out, at, [x for _, x in specials])
            shift = np.array([s for s, _ in specials])
        offs = [m for _, m in marks]
        cuts = total[np.searchsorted(start, offs)]
        if specials:
            cuts = cuts + np.searchsorted(shift, offs)  # those noted before; one at a text's own start is its own
        cuts = np.append(cuts, len(out))
        for k, (i, _) in enumerate(marks):
            part = out[cuts[k] : cuts[k + 1]]
            if carry and carry[0] == i:
                carry[1].append(part)
            else:
                if carry:
                    yield carry[0], carry[1][0] if len(carry[1]) == 1 else np.concatenate(carry[1])
                carry = (i, [part])
    if carry:
        yield carry[0], carry[1][0] if len(carry[1]) == 1 else np.concatenate(carry[1])


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about `size` bytes of text."""
    lengths = np.asarray(pa.compute.binary_length(column).fill_null(0))
    lo, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(lengths):
        yield lo, len(lengths)


SCHEMA = "id long, ids array<int>, decoded string"


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", then: Callable | None = None, schema: str = SCHEMA) -> DataFrame:
    """ids and decoded text of each document (`id, ids, decoded`).

    `then(id column, list of id arrays, vocabulary)` may replace these columns by what it derives from the ids in
    the same task, as an Arrow batch of `schema`.
    """

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column):
                texts = [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
                out, at = [], lo
                for _, ids in encode_texts(texts, vocab):
                    out.append(ids)
                    if len(out) == 500 or at + len(out) == hi:
                        yield (then or as_rows)(batch.column(0).slice(at, len(out)), out, vocab)
                        at, out = at + len(out), []

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), schema)


def as_rows(ids: pa.Array, rows: list[np.ndarray], vocab: Vocabulary) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows).astype(np.int32)))
    return pa.record_batch([ids, lists, pa.array([vocab.decode(r.tolist()) for r in rows], pa.string())], names=["id", "ids", "decoded"])
