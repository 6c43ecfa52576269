"""Cross-entropy difference scores from two matched n-gram models.

A target model is counted over the texts a caller names (good ones, say) and a background model over all documents. Both
use one vocabulary, the words of all documents, and are interpolated bigram models with the same smoothing, so that their per-token
losses can be compared. A document's score is the mean difference of loss (background minus target): higher means nearer
to the target. Each row is scored by models that leave its own counts out, so a text doesn't vouch for itself; its copies do.

Words and (before, word) pairs are counted exactly, by 64-bit hashes; nothing is folded, and no model is gathered or broadcast:

1. Texts are dealt to groups of bounded size. A group sends each of its distinct words and pairs once, with its counts, to
   the shard that the hash names, so a word or pair of all texts reaches its shard once a group.
2. A shard adds up its counts, and answers each group with the totals of what that group sent, in the same order.
3. A group finds its words and pairs again (the exchange of the texts is used twice), and scores its documents.

Shards grow with the input, so what one holds doesn't; groups times shards messages travel, as blocks do in any shuffle.

A null or empty text has no tokens: its losses and score are null. A very long text is a group of its own. Labels that are null name no target; a
document with several labels is a target if one of them says so; rows that repeat count each time, and each leaves out itself alone. An empty target
gives the uniform model. Columns other than id, text and label aren't read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evgraph.llm.bpe import slices
from evgraph.llm.common import binary, mix, pack, unpack
from evgraph.llm.words import word_hashes

SLICE = 1 << 20
#: Bytes of text in a group on average, and for each shard; SHARDS at least.
GROUP = 12 << 20
SHARD = 8 << 20
SHARDS = 8
OUT = "id long, n_tokens long, target_loss double, background_loss double, score double"


def events(texts: list[str]):
    """Word of each token, the word before it (a text starts after 0, which is no word), the pair, all as 64-bit hashes, and bounds."""
    word, first = word_hashes(texts)
    before = np.concatenate((np.zeros(1, word.dtype), word[:-1])) if len(word) else word.copy()
    before[first[:-1][np.diff(first) > 0]] = 0
    return word, before, mix(before * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(1)), first


def coded(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each, those of 255 and more apart."""
    far = values[values >= 255]
    return {name: np.minimum(values, 255).astype(np.uint8), name + "_far": far.astype(np.min_scalar_type(int(far.max(initial=0))))}


def decoded(name: str, part: dict[str, np.ndarray]) -> np.ndarray:
    out = part[name].astype(np.int64)
    out[out == 255] = part[name + "_far"]
    return out


def planes(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as steps, byte by byte: the upper bytes are nearly all zero and compress."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.ravel()


def unplaned(value: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(value.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


class Group:
    """Distinct words and pairs of a group's texts, in the order of their hashes, and each token's place in them."""

    def __init__(self, texts: pa.Array):
        # a text that is longer than a slice is one slice
        parts = [events([t or "" for t in texts.slice(lo, hi - lo).to_pylist()]) for lo, hi in slices(texts, SLICE)]
        word, before, pair = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64) for i in range(3))
        self.n = np.concatenate([np.diff(p[3]) for p in parts]) if parts else np.zeros(0, np.int64)
        self.words, self.word = np.unique(np.concatenate((np.zeros(1, np.uint64), word)), return_inverse=True)
        self.word = self.word[1:]  # the first is no word, and every group has it
        self.before = np.searchsorted(self.words, before)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)

    def counts(self, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, c = (np.bincount(x[where], minlength=len(self.words)) for x in (self.word, self.before))
        return w, c, np.bincount(self.pair[where], minlength=len(self.pairs))


def bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard s holds keys[bounds[s]:bounds[s + 1]], a range of hashes."""
    cuts = np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))


def sent(number: int, group: Group, target: np.ndarray, shards: int) -> pa.Table:
    """A message to each shard; one without words and pairs is empty, for each shard's answer has a part of the totals."""
    mine = np.repeat(target, group.n)
    every, good = group.counts(np.ones(len(mine), bool)), group.counts(mine)
    w, p = bounds(group.words, shards), bounds(group.pairs, shards)
    out = []
    for s in range(shards):
        a, b = slice(w[s], w[s + 1]), slice(p[s], p[s + 1])
        if w[s] == w[s + 1] and p[s] == p[s + 1]:
            out.append(b"")
            continue
        held = {}
        for kind, x in ((0, good), (1, every)):
            for name, i, at in (("w", 0, a), ("c", 1, a), ("p", 2, b)):
                held |= coded(f"{name}{kind}", x[i][at])
        out.append(pack(words=planes(group.words[a]), pairs=planes(group.pairs[b]), **held))
    return pa.table([pa.array([number] * shards, pa.int32()), pa.array(range(shards), pa.int32()), binary(out)], names=["group", "shard", "data"])


def answers(messages: pa.Table) -> pa.Table:
    """The shard's totals of each message's words and pairs, its part of the two models' tokens, and its words."""
    full = pa.compute.binary_length(messages.column("data")).to_numpy() > 0
    values = messages.column("data").filter(pa.array(full))
    keys = {k: [] for k in ("words", "pairs")}
    for v in values:
        part = unpack(v.as_py())
        for k, held in keys.items():
            held.append(unplaned(part[k]))
    have = {k: np.unique(np.concatenate([np.zeros(0, np.uint64), *held])) for k, held in keys.items()}
    total = {f"{name}{kind}": np.zeros(len(have["pairs" if name == "p" else "words"]), np.int64) for name in "wcp" for kind in range(2)}
    places = {k: [np.searchsorted(have[k], x) for x in held] for k, held in keys.items()}
    del keys
    for i, v in enumerate(values):
        part = unpack(v.as_py())
        for name, x in total.items():
            x[places["pairs" if name[0] == "p" else "words"][i]] += decoded(name, part)  # distinct within a message
    figures = np.array([total["w0"].sum(), total["w1"].sum(), np.count_nonzero(have["words"])], dtype=np.int64)
    out, none = [], pack(figures=figures)
    for i in range(len(values)):
        held: dict[str, np.ndarray] = {}
        for name, x in total.items():
            held |= coded(name, x[places["pairs" if name[0] == "p" else "words"][i]])
        out.append(pack(figures=figures, **held))
    told = iter(out)
    return pa.table([messages.column("group"), messages.column("shard"), binary([next(told) if x else none for x in full.tolist()])], names=["group", "shard", "data"])


def own_counts(text: np.ndarray, number: np.ndarray) -> np.ndarray:
    """How often a token's number occurs in its own text."""
    codes, _ = pd.factorize((text << 32) | number)
    return np.bincount(codes)[codes] if len(codes) else codes


def losses(group: Group, tables: dict[str, np.ndarray], figures: np.ndarray, target: np.ndarray, pair_weight: float, floor: float) -> np.ndarray:
    """Per-token loss (nats) under both models, without the counts of the token's own text: a pair model interpolated with a word model,
    that with a uniform one."""
    text = np.repeat(np.arange(len(group.n)), group.n)
    own = [own_counts(text, x) for x in (group.word, group.before, group.pair)]
    length = group.n[text]
    words = max(1, int(figures[2]))
    out = np.empty((2, len(text)))
    for kind in range(2):
        mine = np.ones(len(text), np.int64) if kind else target[text].astype(np.int64)
        word, context, pair = (tables[f"{name}{kind}"][at] - mine * o for name, at, o in zip("wcp", (group.word, group.before, group.pair), own, strict=True))
        p = (1 - floor) * word / np.maximum(1, figures[kind] - mine * length) + floor / words
        share = np.where(context > 0, pair / np.maximum(context, 1), p)
        out[kind] = -np.log(pair_weight * share + (1 - pair_weight) * p)
    return out


def scored(ids: pa.Array, group: Group, target: np.ndarray, replies: list[tuple[int, bytes]], pair_weight: float, floor: float) -> pa.Table:
    parts = [unpack(data) for _, data in sorted(replies, key=lambda r: r[0])]
    figures = np.sum([p["figures"] for p in parts], axis=0)
    tables = {f"{name}{kind}": np.concatenate([np.zeros(0, np.int64), *[decoded(f"{name}{kind}", p) for p in parts if f"{name}{kind}" in p]]) for name in "wcp" for kind in range(2)}
    n = group.n
    first = np.concatenate(([0], np.cumsum(n)))
    loss = losses(group, tables, figures, target, pair_weight, floor)
    sums = np.diff(np.concatenate((np.zeros((2, 1)), np.cumsum(loss, axis=1)), axis=1)[:, first], axis=1)
    none = n == 0
    mean = sums / np.maximum(n, 1)
    return pa.table([ids, pa.array(n, pa.int64()), pa.array(mean[0], mask=none), pa.array(mean[1], mask=none), pa.array(mean[1] - mean[0], mask=none)], names=["id", "n_tokens", "target_loss", "background_loss", "score"])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", target: int = 1, pair_weight: float = 0.5, floor: float = 0.05) -> DataFrame:
    """`id, n_tokens, target_loss, background_loss, score` of every document. The pair model counts `pair_weight`, the word model the rest,
    and within it the uniform one `floor`."""
    good = labels.where((F.col(label_col) == target) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    groups, shards = max(64, -(-size // GROUP)), max(SHARDS, -(-size // SHARD))
    # by the text too: many rows of one id, or of none, aren't one group
    rows = rows.withColumn("group", F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int"))
    # labels grow with the input: never broadcast. The ids join, so each text travels once, at any size
    named = rows.select("id", "group").distinct().join(good.hint("merge"), "id").select(F.col("group").alias("to"), F.col("id").alias("good"))
    texts = rows.repartition(groups, "group")

    def targets(ids: pa.Array, good_ids: list) -> np.ndarray:
        return pa.compute.is_in(ids, value_set=pa.array(good_ids, pa.int64()), skip_nulls=True).to_numpy(zero_copy_only=False)

    def send(key, left, right):
        if not left.num_rows:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.int32()), binary([])], names=["group", "shard", "data"])
        target = targets(left.column("id").combine_chunks(), right.column("good").to_pylist())
        return sent(key[0].as_py(), Group(left.column("text").combine_chunks()), target, shards)

    def receive(left, right):
        replies = list(zip(right.column("shard").to_pylist(), right.column("data").to_pylist(), strict=True))
        ids = left.column("id").combine_chunks()
        target = targets(ids, [int(d) for s, d in replies if s < 0])
        return scored(ids, Group(left.column("text").combine_chunks()), target, [r for r in replies if r[0] >= 0], pair_weight, floor)

    messages = texts.groupBy("group").cogroup(named.groupBy("to")).applyInArrow(send, "group int, shard int, data binary")
    replies = messages.repartition(shards, "shard").groupBy("shard").applyInArrow(answers, "group int, shard int, data binary")
    marked = named.select(F.col("to").alias("group"), F.lit(-1).alias("shard"), F.encode(F.col("good").cast("string"), "utf-8").alias("data"))
    return texts.groupBy("group").cogroup(replies.unionByName(marked).groupBy("group")).applyInArrow(receive, OUT)
