import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evgraph.llm import bpe, packing
from evgraph.llm.queries import word_vocabulary

AWKWARD = [
    "", " ", "it's I'll 'stupid ''s we're'd 'S", "aaaaaaaa bbbb", "<|endoftext|>Hi<|startoftext|>x <|endoftext|>", "<|endoftext|>", "ΣΑΣ İstanbul ǅ ﬁ é \x1c\x1f a b　x", "123 4½ Ⅷ ٣",
    "日本語テキスト 한국어 😀👍🏽 ‍", "a" * 5000, "!!'s 's's don't'm", " x́́ ͅ", "\x00\x01", "é ́", "<|endoftext", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_vocabulary())


def same(texts, library):
    vocab = bpe.vocabulary(word_vocabulary())
    got = dict(bpe.encode_texts(texts, vocab))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = library.encode(t, add_special_tokens=False).ids
        assert got[i].tolist() == want, t
        assert vocab.decode(want) == library.decode(want, skip_special_tokens=False)


def test_awkward(library):
    same(AWKWARD, library)
    same([a + " " + b for a in AWKWARD for b in AWKWARD[2:6]], library)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcdest' \n'<|>"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=5))
def test_any_text(library, texts):
    same(texts, library)


def test_letters_newer_than_python(library):
    new = sorted(bpe.newer())
    same([f"a{c}b{c}{c} 1{c}" for c in new[::3]], library)


def test_thue_morse_words(library):
    """Words that hashes modulo a power of two confuse."""
    for n in (1024, 2048, 4096):
        x = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        y = x.translate(str.maketrans("ab", "ba"))
        same([x + " " + y, y, f"{y} {x} {y}"], library)


def test_words_of_one_hash(library, monkeypatch):
    """Words are told apart by their characters where all hashes are equal."""
    monkeypatch.setattr(bpe, "range_hashes", lambda codes, start, end: np.zeros(len(start), np.uint64))
    same(["one two three one two", "a b a 12 x's " * 5, ""], library)


def test_long_texts_are_cut(library, monkeypatch):
    monkeypatch.setattr(bpe, "STEP_CHARS", 50)
    same([" ".join(f"w{i}x'll" for i in range(400)), "y" * 200, "<|endoftext|> ".join("abc" for _ in range(40))], library)


def test_early_ranks():
    """A vocabulary whose merges make a symbol of an earlier rank."""
    vocab = bpe.Vocabulary.__new__(bpe.Vocabulary)
    tokens = ["a", "b", "c", "ab", "bc", "abc", "abca"]
    ids = {t: i for i, t in enumerate(tokens)}
    pairs = [("ab", "c"), ("abc", "a"), ("b", "c"), ("a", "bc"), ("a", "b")]
    vocab.tokens, vocab.special, vocab.split = tokens, {}, None
    vocab.inner = vocab.last = np.array([ids.get(chr(b), 0) for b in range(256)], dtype=np.int32)
    vocab.left, vocab.right, vocab.made = (np.array(x, dtype=np.int32) for x in zip(*[(ids[a], ids[b], ids[a + b]) for a, b in pairs], strict=True))
    first = np.full(len(tokens), len(pairs))
    np.minimum.at(first, vocab.left, np.arange(len(pairs)))
    np.minimum.at(first, vocab.right, np.arange(len(pairs)))
    vocab.early = first[vocab.made] <= np.arange(len(pairs))
    vocab._table()
    assert vocab.early.any()
    rank = {p: r for r, p in enumerate(pairs)}
    r = random.Random(0)
    words = ["".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(300)]
    got, bounds = vocab.encode_words([w.encode() for w in words])
    for i, w in enumerate(words):
        s = list(w)
        while True:
            best = min(((rank[p], k) for k, p in enumerate(zip(s, s[1:], strict=False)) if p in rank), default=None)
            if best is None:
                break
            s[best[1] : best[1] + 2] = ["".join(s[best[1] : best[1] + 2])]
        assert [tokens[t] for t in got[bounds[i] : bounds[i + 1]]] == s


def test_encode_operator(spark, library):
    rows = [(i, t, 9, [1]) for i, t in enumerate(AWKWARD)] + [(3, AWKWARD[3], 9, [1]), (None, "no id", 9, [1]), (77, None, 9, [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, ids array<int>")
    got = Counter((r["id"], tuple(r["ids"]), r["decoded"]) for r in bpe.encode(docs, word_vocabulary()).collect())
    want = Counter()
    for i, t, *_ in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(e), library.decode(e, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode(docs.limit(0), word_vocabulary()).count() == 0


def check_plan(counts, capacity):
    runs, sequences = packing.plan(counts, capacity)
    by_length = {}
    for length, first, base, offset in sorted(runs):
        by_length.setdefault(length, []).append((first, base, offset))
    placed, used = Counter(), Counter()
    for length, n in counts.items():
        rs = by_length[length]
        assert rs[0][0] == 0
        for (first, base, offset), nxt in zip(rs, [*[r[0] for r in rs[1:]], n], strict=True):
            for rank in range(first, nxt):
                placed[base + rank - first, offset] += length
                used[base + rank - first] += length
    assert sum(used.values()) == sum(k * v for k, v in counts.items()) and max(used.values(), default=0) <= capacity and len(used) == sequences
    at = {}
    for (seq, offset), length in sorted(placed.items()):
        assert at.get(seq, 0) == offset
        at[seq] = offset + length
    return sequences


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), max_size=10))
def test_plan_places_everything(counts):
    check_plan(counts, 24)


def test_plan_quality():
    r = random.Random(3)
    counts = Counter(min(4096, int(r.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    n = check_plan(counts, 4096)
    assert n <= -(-sum(k * v for k, v in counts.items()) // 4096) + 2
    assert check_plan({2049: 7}, 4096) == 7 and check_plan({2048: 7}, 4096) == 4 and check_plan({4096: 3}, 4096) == 3 and check_plan({}, 4096) == 0
    assert check_plan({3000: 1, 1096: 1}, 4096) == 1 and check_plan({3000: 1, 500: 1, 596: 1}, 4096) == 1 and check_plan({3000: 1, 500: 1, 300: 1, 296: 1}, 4096) == 1


def test_pack_documents(spark, library):
    import zlib

    rows = [(i, t, 1) for i, t in enumerate(AWKWARD)] + [(3, AWKWARD[3], 1), (None, None, 1), (50, "x", 1), (51, "x", 1), (52, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    got = packing.pack_documents(docs, word_vocabulary(), capacity=64).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), 64):
            want[i, p // 64, p, tuple(ids[p : p + 64])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in got) == want
    total = sum(len(r["ids"]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-total // 64) + 1
    short = packing.pack_documents(docs, word_vocabulary(), digest=True).collect()
    want = Counter((i, zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes())) for i, t, _ in rows if len(t or "") < 4000)
    assert want <= Counter((r["doc_id"], r["ids_crc32"]) for r in short)
    assert packing.pack_documents(docs.limit(0), word_vocabulary()).count() == 0


def test_pack_lengths_with_any_names(spark):
    rows = spark.createDataFrame([(1 + i % 40, i, 2, 3, 4, 5, 6) for i in range(500)], "length long, _bucket int, _n int, _before int, _rank int, offset int, sequence_id int")
    got = packing.pack_lengths(rows, 64, rows_a_bucket=10).collect()
    assert sorted(r["_bucket"] for r in got) == list(range(500)) and {(r["_n"], r["_before"], r["_rank"]) for r in got} == {(2, 3, 4)}
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        held.sort()
        assert all(o == sum(n for _, n in held[:i]) for i, (o, _) in enumerate(held)) and sum(n for _, n in held) <= 64
