"""License scans, spelling variants and the filter audit against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from evgraph.llm import filter_audit, license_rules, licenses, variants

SCHEMA = "doc_id long, text string, lang string, key string, mask string, part int"


# ---------------------------------------------------------------- filter audit


def audited(rows, good, toxic):
    """Every order walked over every document."""
    docs = []
    least = {}
    for i, t, lang, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), t in least and (i is None or i > least[t])]
        docs.append((lang or "", dict(zip("ABCDE", fails, strict=True)), i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        kept, gone = docs, []
        for step, x in enumerate(order, 1):
            now, stay = [d for d in kept if d[1][x]], [d for d in kept if not d[1][x]]
            for part in {d[0] for d in docs}:
                own = lambda rows: [d for d in rows if d[0] == part]  # noqa: B023, E731
                out[part, order, step] = (len(own(stay)), len(own(now)), len([d for d in own(gone) if d[1][x]]), len([d for d in own(docs) if d[1][x] and sum(d[1].values()) == 1]), sum(d[2] for d in own(now)), sum(d[3] for d in own(now)))
                shapley[part, x] += len(own(now))
            kept, gone = stay, gone + now
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    prose = [" ".join(r.choice(words) for _ in range(r.choice((150, 199, 200, 260, 900)))) for _ in range(20)]
    texts = [*prose, *prose[:6], prose[3], "A" + prose[7], prose[8] + " 5%", prose[9].upper(), "a b " * 400, "ÀÉ " * 300, "x\x0by\x1cz " * 300, "", None, "", " \n", "#", "lone"]
    rows = [(i, t, r.choice(["en", "de", None]), "k", "m", 1) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[2], (3, prose[12], "en", "k", "m", 1), (None, prose[1], "en", "k", "m", 1), (None, None, None, "k", "m", 1), (None, "alone", "fr", "k", "m", 1), (None, "alone", "fr", "k", "m", 1), (-4, prose[2], "de", "k", "m", 1)]
    r.shuffle(rows)
    labels = [(i, i % 3 == 0 and 1 or 0, i % 7 == 0 and 1 or 0, "x") for i in range(45)] + [(3, None, None, "x"), (4, 1, 0, "x"), (None, 1, 1, "x")]
    good, toxic = {i for i, q, _, _ in labels if q == 1 and i is not None}, {i for i, _, t, _ in labels if t == 1 and i is not None}
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = filter_audit.audit(docs, said).collect()
    assert len(got) == len(set(got)) == 600 * len({x[2] or "" for x in rows}) and set(map(tuple, got)) == audited(rows, good, toxic)
    assert filter_audit.audit(docs.limit(0), said).count() == 0
    assert {x["good_lost"] for x in filter_audit.audit(docs, said.limit(0)).collect()} == {0}


def test_filter_audit_of_copies_and_null_ids(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "'the same words' AS text", "'en' AS lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = {x["mask"]: x["n"] for x in filter_audit.cells(filter_audit.failures(rows), labels).collect()}
    assert cells == {1: 1, 17: 4999}


# ---------------------------------------------------------------- spelling variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(rows, every=31, ratio=10):
    words = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in words.items():
        found = sorted((-words[v], v) for v in words if near(w, v))
        form = found[0][1] if found and -found[0][0] >= ratio * n else None
        out[w] = [form, None, n, len(found), words[form] if form else None]
    for w, x in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        x[1] = root
    return {(w, *x) for w, x in out.items()}


def misspelt(r, w):
    p, c = r.randrange(len(w)), r.choice("abcdefgé÷")
    return r.choice((w[:p] + w[p + 1 :], w[:p] + c + w[p:], w[:p] + c + w[p + 1 :]))


@pytest.mark.parametrize("symbols", [1, 2, 4, 9])
def test_spelling_variants(spark, symbols):
    r = random.Random(symbols)
    base = ["".join(r.choice("aeintsor") for _ in range(r.randint(6, 11))) for _ in range(30)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "eéèeéèe", "x" * 300, "straße÷fluß"]
    pool = [w for w in base for _ in range(r.choice((1, 2, 30, 400)))]
    pool += [misspelt(r, w) for w in pool[:400] for _ in range(3)] + [misspelt(r, misspelt(r, w)) for w in base * 6]
    pool += ["chainaaa"] * 900 + ["chainaab"] * 60 + ["chainabb"] * 4
    pool += [w.upper() for w in base] * 2 + ["ÉCOLIERS", "École", "école", "the", "İstanbulda"] * 3
    r.shuffle(pool)
    step = 60
    rows = [(i, ", ".join(pool[lo : lo + step]), "en", "k", "m", 1) for i, lo in enumerate(range(0, len(pool), step))]
    rows += [(None, rows[0][1] + " ẃords日本", "en", "k", "m", 1), (7, None, None, None, None, None), (8, "", "", "", "", 0), (9, " 1234567 _______ ", "", "", "", 0), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = variants.group(docs, symbols=symbols).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == grouped(rows)
    assert any(x["form"] for x in got) and any(x["root"] != x["form"] for x in got if x["form"])
    assert variants.group(docs.limit(0)).count() == 0


def test_shared_reduced_words_are_split_by_halves(spark):
    """With one symbol all words of a length reduce to the same: a key still holds only words with an equal half."""
    r = random.Random(2)
    words = [("".join(r.choice("aeino") for _ in range(10)), 2) for _ in range(3000)]
    table = spark.createDataFrame(sorted(set(words)), "word string, n long")
    met = Counter()
    for w, _ in set(words):
        met[w[:5]] += 1
        met[w[5:]] += 1
    pairs = variants.near_pairs(table, symbols=1)
    assert {tuple(sorted((x["a"], x["b"]))) for x in pairs.collect()} == {(a, b) for a, b in itertools.combinations(sorted({w for w, _ in words}), 2) if near(a, b)}
    assert sum(n * n for n in met.values()) < len(set(words)) ** 2 / 100


# ---------------------------------------------------------------- licence scan

LINES = [
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "SPDX-License-Identifier: BSD-3-Clause",
    "SPDX-License-Identifier: GPL-2.0-or-later", "see http://www.apache.org/licenses/LICENSE-2.0.txt", "https://creativecommons.org/licenses/by-sa/4.0/ CC BY", "mit license MIT LICENSE mit-license", "apache license mit license cc by cc  by",
    "GNU Lesser General Public License v2.1 or later", "All rights reserved. Public domain.", "the GNU general public licence", "GNU\u00a0General Public License", "permission is hereby granted, free of charge, to any person",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "Licensed under the MIT license. Licensed under the MIT license. Apache License 2.0 or MIT license", "the mit licenses and apache licensed cc bye", "gnu gnu general public license license", "MİT LICENSE mit LICENSE\u212a", "Expat License; ISC License",
]


COMPILED = [(r, re.compile(licenses.spaced(r.pattern))) for r in license_rules.rules()]


def scanned(text):
    """Every rule over every text, every pair of detections."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = [(i, label) for i in range(len(w)) for p, label in licenses.BASE.items() if w[i : i + p.count(" ") + 1] == p.split(" ")]
    spaced, found = "".join(f" {x} " for x in w), []
    for r, pattern in COMPILED:
        for m in pattern.finditer(spaced):
            found.append((spaced[: m.start()].count(" ") // 2, spaced[: m.end()].count(" ") // 2, r.tier, r.number, r.label))
    rank = lambda x: (x[2], x[0] - x[1], x[3])
    stands = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and rank(e) < rank(d) for e in found)]
    labels = {x[1] for x in base} | {x[4] for x in stands}
    sure = max([license_rules.CONFIDENCE[x[2]] for x in stands] + [licenses.MENTION if base else 0.0])
    at = [i for i, _ in base]
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x[1] for x in base})), ",".join(sorted(labels)), len(stands), sure), {(s, e, t, label) for s, e, t, _, label in stands}


def test_license_scan(spark):
    r = random.Random(3)
    filler = lambda n: " ".join(r.choice(["ere", "License", "apache", "mit", "cc", "by", "éà", "gnu", "日本", "x1"]) for _ in range(n))
    texts = [*LINES, *[f"{filler(20)} {x}\n{filler(9)}" for x in LINES], "\n".join(LINES), " ".join(LINES[:9] * 300), *[filler(400) for _ in range(8)], "", None, " .,; ", "apache"]
    rows = [(i, t, "en", "k", "m", 1) for i, t in enumerate(texts)] + [(None, LINES[0], "en", "k", "m", 1), (None, LINES[0], "en", "k", "m", 1), (None, None, "en", "k", "m", 1), (3, texts[4], "en", "k", "m", 1), (5, texts[5], "x", "k", "m", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = licenses.scan(docs).collect()
    key = lambda x: str(x)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *scanned(t)[0]) for i, t, *_ in rows), key=key)
    one = {(x["start"], x["end"], x["tier"], x["label"]) for x in licenses.detections(docs.where("doc_id = 42")).collect()}
    assert one == scanned(texts[42])[1] and len(one) > 15
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_rules():
    rules = license_rules.rules()
    assert len(rules) > 300 and [r.tier for r in rules] == sorted(r.tier for r in rules) and [r.number for r in rules] == list(range(len(rules)))
    assert all(re.search(rf"(^|[^a-z0-9]){k}([^a-z0-9]|$)", r.pattern) for r in rules for k in r.keywords)
    assert sum(len(r.keywords) == 2 for r in rules) > 100


def sample(pattern, r):
    """A text that a pattern matches."""
    while "(" in pattern:
        pattern = re.sub(r"\(\?:([^()]*)\)(\?|\{0,6\})?", lambda m: r.choice(m[1].split("|")) if not m[2] or r.random() < 0.5 else "", pattern, count=1)
    return re.sub(r"\[([^\]])[^\]]*\]\+?", r"\1", re.sub(r"(.)\?", lambda m: r.choice((m[1], "")), r.choice(pattern.split("|"))))


def test_every_rule_finds_its_samples(spark):
    r = random.Random(11)
    texts = [sample(rule.pattern, r) for rule in license_rules.rules() for _ in range(2)]
    got = {x["id"]: tuple(x)[1:] for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == scanned(t)[0] and got[i][6] > 0, t


def test_detections_of_one_text_stay_linear(spark):
    """A text of 20,000 licence lines is sorted, not compared pair by pair."""
    docs = spark.createDataFrame([(1, " ".join(["Licensed under the MIT License"] * 20000))], "doc_id long, text string")
    x = licenses.scan(docs).first()
    assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["labels"], x["n_detections"]) == (100000, 20000, 3, 99998, "mit", 20000)
