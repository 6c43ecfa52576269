"""Toxicity scores from a weighted finite-state grammar over clauses (`grammar`).

Words are read as kinds: insults (learned), threats, targets, negations, verbs of saying, others. Five transducers, composed to one,
turn a clause's kinds into events: an insult or a threat with what the clause says of it (targeted, negated, reported, again).
A text's score is a logistic curve over its events, so what counts is the path through the clause and not the word.

Learned parts: the insults, words that labelled toxic documents hold in many different contexts and clean ones don't (log odds; a word
counts once for each word before it, so a passage that many copies share counts once), and the events' weights, by a logistic
regression drawn towards the built-in ones, so events that no label shows keep these. Both use the labelled rows of training only, at
most `max_labelled` of them (a documented bound; those of least hash). The lexicon has no other bound: its words each need a share of the
toxic documents, so their number follows from that share. Labels, language, source and ids are no inputs of a score.

Words match as a whole, or with a regular ending (ENDINGS). A beginning alone matches only where it is a stem: one that at least STEM_WORDS
different words of toxic documents share and clean documents hardly have. Null and empty texts have no clauses and get
the score of a text without events; a very long text is read whole, in one pass over its words. Labels that are null don't count; a document with
several labels counts as toxic if one of them says so. Repeated rows are scored alike, ties don't arise. Columns other than id and text
aren't read. An empty table gives no rows. Without usable labels the built-in words and weights stand alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.llm import grammar as g
from evgraph.llm.bpe import slices
from evgraph.llm.common import lean

THREAT = "kill murder hurt destroy beat burn shoot stab hang strangle töten umbringen erschießen tuer frapper égorger matar golpear"
TARGET = "you your you're yourself they them their he she her him his people du dich dir euch ihr tu toi te vous tú ti usted ustedes"
NEGATION = "not no never isn't aren't wasn't don't won't can't cannot nicht kein keine nie pas jamais nunca"
REPORT = "said says say told tells wrote writes claimed claims quoted reported reports sagte sagt schrieb dit écrit dijo escribió"
ENDINGS = ("s", "es", "'s", "ed", "ing")
TOKEN = re.compile(r"[\w']+|[.!?;:\n]")
STOPS = ".!?;:\n"
AFTER, WRITTEN, EVENTS = g.compose()
OTHER, INSULT, THREATS, END = (g.KINDS.index(k) for k in ("other", "insult", "threat", "end"))
STEMS = (4, 5, 6, 7)
STEM_WORDS = 10


class Kinds(dict):
    """Kind of each word: known ones, and any that begins with a stem. Words once looked up are held, 200,000 at most."""

    def __init__(self, known: dict[str, int], stems: frozenset[str]):
        super().__init__(known)
        self.known, self.stems, self.sizes = known, stems, sorted({len(s) for s in stems})

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
            self.update(self.known)
        kind = INSULT if any(len(word) > n and word[:n] in self.stems for n in self.sizes) else OTHER
        return self.setdefault(word, kind)


@dataclass
class Grammar:
    """The insults, stems of such, and the weights of events: bias first."""

    insults: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    weights: tuple[float, ...] = field(default_factory=lambda: (-4.0, *(g.prior_weight(e) for e in EVENTS)))

    @cached_property
    def kinds(self) -> Kinds:
        """Kind of each word, endings included."""
        out: dict[str, int] = {}
        for kind, words in (("insult", self.insults), ("threat", THREAT.split())):
            for w in words:
                for end in ("", *ENDINGS):
                    out[w + end] = g.KINDS.index(kind)
        for w in THREAT.split():  # burning, hanged, stabbed
            for end in ("ed", "ing"):
                out[(w[:-1] if w.endswith("e") else w + w[-1]) + end] = g.KINDS.index("threat")
        for kind, words in (("target", TARGET), ("negation", NEGATION), ("report", REPORT)):
            out |= dict.fromkeys(words.split(), g.KINDS.index(kind))
        return Kinds(out | dict.fromkeys(STOPS, END), self.stems)

    def events(self, text: str) -> np.ndarray | None:
        """How often each event is written along the text's path; None where there is none."""
        known = self.kinds
        kinds = [known[t] for t in TOKEN.findall(text.lower())]
        if INSULT not in kinds and THREATS not in kinds:
            return None
        out, state = [0] * len(EVENTS), 0
        for kind in kinds:
            event = WRITTEN[state][kind]
            if event >= 0:
                out[event] += 1
            state = AFTER[state][kind]
        return np.array(out)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(EVENTS)), dtype=np.int64)
        for i, text in enumerate(texts):
            found = self.events(text) if text else None
            if found is not None:
                out[i] = found
        return out

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.weights[0] + scaled(counts) @ np.array(self.weights[1:]), -30, 30)))


def scaled(counts: np.ndarray) -> np.ndarray:
    """An event counts fully once, further ones by their logarithm."""
    return np.where(counts > 0, 1.0 + np.log(np.maximum(counts, 1)), 0.0)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """(id, text, toxic) of at most `max_labelled` documents, those of least hash."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(known, "id")


def learn_insults(rows: DataFrame, n1: int, n0: int, least_share: float, least_odds: float) -> tuple[frozenset[str], frozenset[str]]:
    """Insults, and stems."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_']+)"), F.lit(1))
    before = F.concat(F.array(F.lit("")), F.col("w"))
    each = rows.select("toxic", words.alias("w")).where(F.size("w") > 0)
    pairs = F.zip_with("w", F.slice(before, 1, F.size("w")), lambda w, b: F.struct(w.alias("w"), b.alias("b")))  # grouped next, so repeats don't count
    each = each.select("toxic", F.explode(pairs).alias("x")).select("toxic", "x.w", "x.b")
    contexts = each.groupBy("w", "b").agg(F.max("toxic").alias("p"), F.max(1 - F.col("toxic")).alias("n"))
    counts = contexts.groupBy("w").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).persist()
    odds = F.log((F.col("p") + 0.5) / (n1 + 1)) - F.log((F.col("n") + 0.5) / (n0 + 1))
    telling = (F.col("p") >= max(5, least_share * n1)) & (odds >= least_odds)
    # words and stems each need a share of the toxic documents' contexts, so these lists stay short whatever the input
    stems = counts.select("p", "n", "w", F.explode(F.filter(F.array(*[F.substring("w", 1, n) for n in STEMS]), lambda x: F.length(x) < F.length("w"))).alias("stem")).distinct()
    stems = stems.groupBy("stem").agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum((F.col("p") > 0).cast("int")).alias("words")).where(telling & (F.col("words") >= STEM_WORDS))
    found = {r["stem"]: r["p"] for r in stems.collect()}
    # of nested stems the longest that holds most of the contexts
    whole = {x for x, p in found.items() if not any(len(y) > len(x) and y.startswith(x) and q >= 0.7 * p for y, q in found.items())}
    short = frozenset(x for x in whole if not any(x[:n] in whole for n in STEMS if n < len(x)))
    insults = frozenset(w for (w,) in counts.where(telling).select("w").collect() if not any(w[:n] in short for n in STEMS))
    counts.unpersist()
    return insults, short


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = 20_000, least_share: float = 0.03, least_odds: float = 3.0) -> Grammar:
    """Fits the insults and the weights. A word is an insult if it has at least `least_share` times as many contexts in toxic documents as there
    are of these (five at least), and log odds of at least `least_odds`."""
    rows = labelled(docs, labels, id_col, text_col, label_col, max_labelled).persist()
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    out = Grammar()
    if counts.get(1) and counts.get(0):
        out = Grammar(*learn_insults(rows, counts[1], counts[0], least_share, least_odds))
        found = events_of(rows, out, "toxic").groupBy("toxic", "events").agg(F.count("*").alias("n")).toArrow()  # of at most `max_labelled` rows
        x = np.array(found.column("events").to_pylist(), dtype=np.int64).reshape(-1, len(EVENTS))
        out = Grammar(out.insults, out.stems, fit(scaled(x), found.column("toxic").to_numpy().astype(float), found.column("n").to_numpy().astype(float), np.array(out.weights)))
    rows.unpersist()
    return out


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> tuple[float, ...]:
    """Logistic regression by Newton's method, each row n times, drawn towards the prior weights (the bias hardly)."""
    x = np.column_stack([np.ones(len(x)), x])
    w, damp = prior.astype(float).copy(), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - damp @ (w - prior)
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + damp, slope)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def events_of(docs: DataFrame, grammar: Grammar, *keep: str) -> DataFrame:
    """id, the kept columns, and `events` and `score` of each text."""

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for lo, hi in slices(column):
                x = grammar.counts(column.slice(lo, hi - lo).to_pylist())
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(EVENTS)).cast(pa.list_(pa.int64()))
                yield pa.record_batch([*[batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)], lists, pa.array(grammar.score(x))], names=["id", *keep, "events", "score"])

    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select("id", *keep, "text").mapInArrow(lean(run), f"id long{kept}, events array<long>, score double")


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, events, score` of every document; `events` has the counts of EVENTS."""
    return events_of(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), grammar)


def keep_clean(docs: DataFrame, grammar: Grammar, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score under the threshold, with all their columns; nothing is shuffled."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(place)):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(grammar.score(grammar.counts(part.column(place).to_pylist())) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0
