"""Words (runs of letters and digits, lower case) of many texts as arrays of hashes."""

from __future__ import annotations

import numpy as np

from evgraph.llm.bpe import STEP_CHARS, char_classes, normalised
from evgraph.llm.common import range_hashes, window_hashes


def hash_word(word: str) -> int:
    return int(word_hashes([word])[0][0])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after another, and the first word of each text (one more at the end)."""
    classes, codes = char_classes()
    counts, out = np.zeros(len(texts), dtype=np.int64), []
    parts: list[str] = []
    owners: list[int] = []
    size = 0

    def close() -> None:
        points = np.frombuffer("\n".join(parts).encode("utf-32-le"), dtype=np.uint32)
        kind = classes[points]
        word = np.zeros(len(kind) + 2, dtype=np.int8)
        word[1:-1] = (kind == 1) | (kind == 2)
        step = np.diff(word)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        out.append(range_hashes(codes[points], start, end))
        heads = np.cumsum([0] + [len(p) + 1 for p in parts])
        np.add.at(counts, owners, np.diff(np.searchsorted(start, heads)))

    for i, text in enumerate(texts):
        part = normalised(text)
        while True:  # a long text is cut at white space
            cut = len(part) if len(part) <= STEP_CHARS else max(part.rfind("\n", 1, STEP_CHARS), part.rfind(" ", 1, STEP_CHARS))
            cut = len(part) if cut <= 0 else cut
            parts.append(part[:cut])
            owners.append(i)
            size += cut + 1
            part = part[cut:]
            if size > STEP_CHARS:
                close()
                parts, owners, size = [], [], 0
            if not part:
                break
    if parts:
        close()
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(counts)))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of each text, and the first of each text. A text of fewer words, but one at
    least, has the run of all its words."""
    n = np.diff(first)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(begin[-1])
    full = np.repeat(n >= size, counts)
    out = np.empty(len(at), dtype=np.uint64)
    out[full] = window_hashes(hashes, size)[at[full]]
    short = np.flatnonzero((n > 0) & (n < size))
    out[~full] = range_hashes(hashes, first[:-1][short], first[1:][short])
    return out, begin
