"""Substring, suffix-array and Jaccard operators against brute force, on texts with every awkward case."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from evgraph.llm import jaccard, substring, suffix

SCHEMA = "doc_id long, text string, key long, `group` string, kept string, c0 int"


def corpus(seed=1):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(400)] + ["é", "日本語", "😀x", "a,b"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, prose = line(60), [line(r.randint(3, 120)) for _ in range(40)]
    texts = [*prose, *prose[:5], prose[7], passage, f"{line(20)} {passage} {line(20)}", f"{line(9)}\n\t{passage}  {line(3)}", passage + " " + passage, "", None, " \n ", "one", "x" * 700, "ab" * 400, line(30000)]
    for t in prose[10:16]:
        w = t.split(" ")
        w[len(w) // 2] = "edit"
        texts.append(" ".join(w))
    rows = [(i, t, 1, "g", "k", 2) for i, t in enumerate(texts)]
    rows += [(3, texts[3], 1, "g", "k", 2), (4, line(40), 1, "g", "k", 2), (None, passage, 1, "g", "k", 2), (None, None, 1, "g", "k", 2)]
    r.shuffle(rows)
    return rows


def as_id(i):
    return float("inf") if i is None else i


def test_remove_repeated_windows(spark):
    rows = corpus()
    first: dict = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    for i, w in split:
        for p in range(len(w) - 12):
            first[tuple(w[p : p + 13])] = min(first.get(tuple(w[p : p + 13]), float("inf")), as_id(i))
    want = Counter()
    for i, w in split:
        gone = {p + k for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < as_id(i) for k in range(13)}
        want[i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)] += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for cells in (4, 1e-3):  # a sketch that is full changes nothing
        got = substring.remove_repeated_windows(docs, cells=cells)
        assert Counter(tuple(r) for r in got.select("id", "n_words", "n_removed", "kept").collect()) == want
    assert substring.remove_repeated_windows(docs.limit(0)).count() == 0


def brute_bytes(rows, length=200):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = Counter()
    for i, b in data:
        gone = set()
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone.update(range(s, s + length))
        spans = sum(p - 1 not in gone for p in gone)
        out[i, len(b), len(gone), spans, hashlib.sha256(bytes(x for p, x in enumerate(b) if p not in gone)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_remove_repeated_bytes(spark, hot, monkeypatch):
    rows = corpus(2)
    if hot:  # all anchors of the sample count as hot
        monkeypatch.setattr(suffix, "Counter", lambda values: {v: 10**9 for v in values})
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = Counter((r["id"], r["n_bytes"], r["n_removed"], len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest()) for r in suffix.remove_repeated(docs).collect())
    assert got == brute_bytes(rows)
    assert suffix.remove_repeated(docs.limit(0)).count() == 0


def test_small_pieces(spark, monkeypatch):
    """Contexts don't depend on how long texts are cut."""
    import numpy as np

    r = random.Random(5)
    text = "".join(r.choice("abc \n") for _ in range(9000)).encode()
    data, offsets = np.frombuffer(text * 2 + b"xyz", dtype=np.uint8), np.array([0, 9000, 18000, 18003])
    real = suffix.pieces

    def windows():
        doc, start, end, anchor, h, _ = suffix.contexts(data, offsets, 200)
        return {(int(d), int(s) + k, int(a), int(x)) for d, s, e, a, x in zip(doc, start, end, anchor, h, strict=True) for k in range(int(e - s) - 199)}

    whole = windows()
    monkeypatch.setattr(suffix, "pieces", lambda o, n: real(o, n, 1000))
    assert windows() == whole and len(whole) == 2 * (9000 - 199)


def test_suffix_work(monkeypatch):
    """Anchors are hashed where they stand and not at all places, and strings are sorted only where a character parts them."""
    from evgraph.llm import common

    r = random.Random(11)
    data = np.frombuffer(bytes(r.choices(range(97, 123), k=200_000)), dtype=np.uint8)
    hashed, both, sorted_, lexsort = [], common._both, [], np.lexsort
    monkeypatch.setattr(common, "_both", lambda left, right, kind: (hashed.append(left.size), both(left, right, kind))[1])
    monkeypatch.setattr(np, "lexsort", lambda keys, *a, **k: (sorted_.append(len(keys[0])), lexsort(keys, *a, **k))[1])
    _, start, end, *_ = suffix.contexts(data, np.array([0, len(data)]), 200)
    assert sum(hashed) < len(data)
    suffix.string_hashes(data, start, end)
    assert sum(hashed) < 4 * len(data)
    assert suffix.equal_strings(np.tile(data, 2), np.concatenate([np.arange(9000)] * 2 + [np.arange(9000) + len(data)]), np.tile(np.arange(9000), 3), 200).all()
    assert sum(sorted_) < 2 * 27_000


@pytest.mark.parametrize("length", [65, 200, 201, 331])
def test_anchors_and_equal_strings(length):
    """Against brute force: contexts hold each string once with an anchor that depends on it alone, and ties of any size are parted."""
    r = random.Random(length)
    base = [bytes(r.choices(b"ab", k=700)) for _ in range(3)] + [b"x" * 500, b"", b"ab" * 300]
    texts = [*base, *[t[: len(t) // 2] + b"-" + t[len(t) // 2 :] for t in base], bytes(r.choices(b"abc", k=40_000)) + base[0], base[1] + base[0]]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    seen, met = {}, Counter()
    for d, s, e, a, h, g in zip(*(x.tolist() for x in suffix.contexts(data, offsets, length)), strict=True):
        for p in range(s, e - length + 1):
            met[d, p - int(offsets[d])] += 1
            assert seen.setdefault(data[p : p + length].tobytes(), (a - p, h, g)) == (a - p, h, g) and 0 <= a - p <= length - suffix.GRAM
    assert met == Counter((d, p) for d, t in enumerate(texts) for p in range(len(t) - length + 1))
    starts = np.array(r.choices(range(len(data) - length + 1), k=3000) + list(range(1500)) * 2, dtype=np.int64)
    group = np.array(r.choices(range(7), k=len(starts)), dtype=np.int64)
    keys = [(g, data[p : p + length].tobytes()) for g, p in zip(group.tolist(), starts.tolist(), strict=True)]
    count = Counter(keys)
    assert suffix.equal_strings(data, starts, group, length).tolist() == [count[k] > 1 for k in keys]


def test_range_hashes_by_both_ways():
    """A range's hash doesn't depend on what else is hashed with it."""
    from evgraph.llm import common

    r = np.random.default_rng(3)
    data = r.integers(97, 100, 5000).astype(np.uint8)
    start = np.arange(4000)
    for size in (17, 31, 32, 64, 65, 200, 336, 999):
        for kind in range(2):
            every = common.byte_range_hashes(data, start, start + size, kind)  # overlap much
            assert (every[::500] == common.byte_range_hashes(data, start[::500], start[::500] + size, kind)).all()


def test_carry_and_text(spark):
    docs = spark.createDataFrame([(1, "é" * 300, "a"), (2, "z" + "é" * 300, "b"), (3, None, None)], "doc_id long, text string, id string")
    got = {r["id"]: r for r in suffix.remove_repeated(docs, carry=("id", "doc_id"), as_text=True).collect()}
    assert got[1]["kept"] == "" and got[2]["kept"] == "z" and got[3]["kept"] == "" and got[2]["c0"] == "b" and got[2]["c1"] == 2


def grams(text):
    import regex

    w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(rows, threshold=0.8):
    sets = [grams(t) for _, t, *_ in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if (not x and not y) or (x and y and len(x & y) >= threshold * len(x | y) - 1e-9):
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(lambda: float("inf"))
    for i, row in enumerate(rows):
        least[find(i)] = min(least[find(i)], as_id(row[0]))
    return Counter((row[0], None if least[find(i)] == float("inf") else least[find(i)], links[i]) for i, row in enumerate(rows))


@pytest.mark.parametrize("block", [1500, 4])
def test_jaccard_join(spark, block):
    rows = corpus(3)
    base = [f"v{i}" for i in range(60)]
    rows += [(500 + k, " ".join(base[:k] + ["new%d" % k] + base[k + 1 :]), 1, "g", "k", 2) for k in range(0, 60, 4)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in jaccard.join(docs, block=block).select("id", "class_id", "n_links").collect())
    assert got == classes(rows)


def test_links_across_length_classes(spark):
    """One candidate component of many lengths, in blocks of three: each text is a beginning of the next, so links run within and between classes."""
    words = [f"w{i}" for i in range(80)]
    rows = [(k, " ".join(words[:k]), 1) for k in range(9, 81)] + [(100 + k, " ".join(words[:k] + [f"x{k}"]), 1) for k in range(40, 80, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p int").repartition(3)
    assert Counter(tuple(r) for r in jaccard.join(docs, block=3).select("id", "class_id", "n_links").collect()) == classes(rows)


def test_keep_first(spark):
    rows = [r for r in corpus(4) if r[0] != 4]  # an id of two texts can name two classes
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(c for _, c in {(c, c) for _, c, _ in classes(rows)})
    assert jaccard.join(docs.limit(0)).count() == 0 and jaccard.keep_first(docs.limit(0)).count() == 0


@pytest.mark.parametrize("same_id", [1, None])
def test_copies_of_a_row_send_one_set(spark, same_id, monkeypatch):
    """5,000 equal rows and a near copy: the task that they meet in sends two sets, and all rows get their class."""
    sent = []
    real = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda units, threshold: sent.append(units.count()) or real(units, threshold))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(5000).selectExpr(f"CAST({'NULL' if same_id is None else same_id} AS LONG) AS doc_id", f"'{text}' AS text").unionByName(spark.createDataFrame([(2, text + " more"), (3, "something else")], "doc_id long, text string"))
    got = Counter((x["id"], x["class_id"], x["n_links"]) for x in jaccard.join(docs.repartition(7)).select("id", "class_id", "n_links").collect())
    least = 2 if same_id is None else 1
    assert got == {(same_id, least, 5000): 5000, (2, least, 5000): 1, (3, 3, 0): 1} and sent[0] <= 16


def test_keep_first_of_rows_without_id(spark):
    schema = "doc_id long, text string, _id string, _key string, _n int, key string"
    lone = [(None, "one two three four five six", "A", "B", 7, "k"), (None, "quite another text of some words", "A", "C", 8, "k")]
    twice = [(None, "nobody has given this text a number", "D", x, 9, "k") for x in "FE"]
    known = [(2, "seven eight nine ten eleven twelve", "G", "H", 1, "k"), (None, "seven eight nine ten eleven twelve", "I", "J", 2, "k"), (1, "short", "K", "L", 3, "k"), (None, None, "M", "N", 4, "k")]
    kept = jaccard.keep_first(spark.createDataFrame(lone + twice + known, schema).repartition(3))
    assert kept.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([*lone, twice[1], known[0], known[2], known[3]], key=str)


def test_ties_of_equal_rows(spark):
    rows = [(1, "a b c", c, "g", "k", 2) for c in (3, 1, 2)]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        kept = jaccard.keep_first(spark.createDataFrame(order, SCHEMA).coalesce(1)).collect()
        assert [r["key"] for r in kept] == [1]


def test_bands():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (1.0, 0.99)):
        bands, rows = jaccard.choose_bands(threshold, recall)
        assert bands * rows <= jaccard.MOST_HASHES and 1 - (1 - threshold**rows) ** bands >= recall - 1e-9


def thue_morse(n, a="a", b="b"):
    """The word of 2**k letters and its complement: hashes that are polynomials modulo a power of two can't tell them apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [(a, b)[x] for x in bits], [(b, a)[x] for x in bits]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_texts_stay_apart(spark, n):
    x, y = thue_morse(n)
    u, v = thue_morse(n, "left ", "right ")
    texts = ["".join(x), "".join(y), "".join(u), "".join(v), "".join(x) + " " + "".join(y), "".join(u) + "| " + "".join(v)]
    rows = [(i, t, 1, "g", "k", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {tuple(r) for r in jaccard.join(docs, threshold=1.0, ngram=5).select("id", "class_id").collect()}
    words = [tuple(re.findall(r"\w+", t)) for t in texts]
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} for w in words]
    assert got == {(i, min(j for j in range(len(texts)) if sets[j] == sets[i])) for i in range(len(texts))}
    spaced = [(i, " ".join(t) if i < 2 else t, *rest) for i, t, *rest in rows]
    brute = {}
    for i, t, *_ in spaced:
        w = t.split()
        brute |= {k: min(i, brute.get(k, i)) for k in (tuple(w[p : p + 13]) for p in range(len(w) - 12))}
    want = Counter()
    for i, t, *_ in spaced:
        w = t.split()
        gone = {p + k for p in range(len(w) - 12) if brute[tuple(w[p : p + 13])] < i for k in range(13)}
        want[i, len(w), len(gone), " ".join(z for p, z in enumerate(w) if p not in gone)] += 1
    got = substring.remove_repeated_windows(spark.createDataFrame(spaced, SCHEMA))
    assert Counter(tuple(r) for r in got.select("id", "n_words", "n_removed", "kept").collect()) == want
    left = suffix.remove_repeated(docs)
    assert Counter((r["id"], r["n_removed"], bytes(r["kept"])) for r in left.collect()) == Counter((i, b, k) for i, b, k in brute_removed(rows))


def brute_removed(rows, length=200):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    for i, b in data:
        gone = {s + k for s in range(len(b) - length + 1) if count[b[s : s + length]] > 1 for k in range(length)}
        yield i, len(gone), bytes(x for s, x in enumerate(b) if s not in gone)


def test_messages_of_the_sketch():
    r = np.random.default_rng(1)
    for gap in (1, 100, 5_000, 3_000_000):
        cells = np.cumsum(r.integers(1, 2 * gap + 1, 500))
        twice = r.random(500) < 0.1
        a, b = substring.cells_got(substring.cells_sent(cells, twice))
        assert (a == cells).all() and (b == twice).all()


def test_single_windows_stay_home_at_any_size():
    """With four cells a window, few single windows pass whatever the input; the messages grow by a step's width only."""
    r = np.random.default_rng(2)
    for n in (20_000, 320_000):
        bits = int(np.ceil(np.log2(4 * n)))
        h = [r.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2)]
        used = [np.bincount((x >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) >= 2 for x in h]
        passed = np.mean([used[0][(h[0] >> np.uint64(64 - bits)).astype(np.int64)] & used[1][(h[1] >> np.uint64(64 - bits)).astype(np.int64)]])
        own = np.unique((h[0][:2000] >> np.uint64(64 - bits)).astype(np.int64))
        assert passed < 0.07 and len(substring.cells_sent(own, np.zeros(len(own), bool))) < 3 * len(own)
