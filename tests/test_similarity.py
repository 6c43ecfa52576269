"""Common neighbours and the Tanimoto join against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import pytest

from evgraph.operators import neighbours
from evgraph.operators.components import connected_components
from evgraph.operators.similarity import Fingerprints, candidates, clusters, members, similar, similar_classes

EDGE = "_from string, _type string, _to string, from_label string, to_label string, hub string, place int"


def bipartite(seed):
    r = random.Random(seed)
    rows = []
    for n in range(60):
        for h in {min(int(r.expovariate(0.25)), 14) for _ in range(r.randint(1, 8))}:
            ends = (f"n{n}", f"h{h}") if r.random() < 0.5 else (f"h{h}", f"n{n}")
            rows += [(ends[0], r.choice("XY"), ends[1], "N" if ends[0][0] == "n" else "H", "N" if ends[1][0] == "n" else "H", "x", 1)] * r.randint(1, 2)
    rows += [(f"copy{i}", "X", "h3", "N", "H", "x", 1) for i in range(70)] + [(f"pair{i}", "X", h, "N", "H", "x", 1) for i in range(5) for h in ("h1", "h2", "h5", "h6")]
    rows += [("n1", "X", "n1", "N", "N", "x", 1), (None, "X", "h1", None, "H", "x", 1), ("n2", "X", None, "N", None, "x", 1), ("n5", "X", "t1", "N", "T", "x", 1), ("n6", "X", "t1", "N", "T", "x", 1)]
    return rows


def shared(rows, hubs=("H",)):
    of = defaultdict(set)
    for a, _, b, la, lb, *_ in rows:
        if a and b and a != b:
            if lb in hubs:
                of[a].add(b)
            if la in hubs:
                of[b].add(a)
    return {(a, b): len(of[a] & of[b]) for a, b in itertools.combinations(sorted(of), 2) if of[a] & of[b]}


@pytest.mark.parametrize("block", [1000, 7])
def test_common_neighbours(spark, block):
    rows = bipartite(block)
    edges = spark.createDataFrame(rows, EDGE).repartition(5)
    near, want = neighbours.adjacency(edges, ["H"]), shared(rows)
    for least in (1, 2, 4, 9):
        got = {(x["a"], x["b"]): x["n_common"] for x in neighbours.common_neighbours(near, least, block).collect()}
        assert got == {k: n for k, n in want.items() if n >= least}
    counts = neighbours.pair_counts(near, block).collect()
    assert {x["n_common"]: x["pairs"] for x in counts} == Counter(want.values()) and len(counts) == len(set(want.values()))
    assert neighbours.shared_pairs(near, block).first().asDict() == {"pairs": len(want), "incidences": sum(want.values())}
    for k in (1, 12, 100, 10**6):
        assert [tuple(x) for x in neighbours.top_common(near, k, block).collect()] == sorted(((*p, n) for p, n in want.items()), key=lambda x: (-x[2], x[:2]))[:k]
    every = {(x["a"], x["b"]): x["n_common"] for x in neighbours.common_neighbours(neighbours.adjacency(edges, without=["T"])).collect()}
    assert every == shared([x for x in rows if x[4] and x[3]], ("H", "N"))
    assert neighbours.pair_counts(near.limit(0)).count() == 0 and neighbours.top_common(near.limit(0), 5).count() == 0
    assert neighbours.shared_pairs(near.limit(0)).first().asDict() == {"pairs": 0, "incidences": 0}


def test_a_hub_of_equal_nodes_makes_no_pairs(spark):
    """A million leaves of one hub are one class: their pairs are counted, not made. A pair with two hubs is found without the large one."""
    leaves = spark.range(1_000_000).selectExpr("concat('x', id) AS a", "'hub' AS hub")
    two = spark.createDataFrame([(a, h) for a in ("p", "q") for h in ("hub", "small")], "a string, hub string")
    near = leaves.unionByName(two)
    assert {x["n_common"]: x["pairs"] for x in neighbours.pair_counts(near).collect()} == {1: 1_000_000 * 999_999 // 2 + 2_000_000, 2: 1}
    assert [tuple(x) for x in neighbours.top_common(near, 1).collect()] == [("p", "q", 2)]
    assert {x["hub"] for x in neighbours.rarest_hubs(near, 2).collect()} == {"small"}


def test_no_unit_of_wedges_grows_with_its_hub(spark):
    near = spark.range(400).selectExpr("concat('x', lpad(id, 4, '0')) AS a", "'hub' AS hub")
    assert neighbours.wedges(neighbours.with_degrees(near), 50).distinct().count() == 400 * 399 // 2


def shuffled_rows(spark):
    context = spark.sparkContext
    stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_pairs_are_not_shuffled(spark):
    """40 hubs of 200 nodes make 796,000 pairs; what travels is a list for each node and hub."""
    near = spark.range(8000).selectExpr("concat('n', id % 2000) AS a", "concat('h', id * 7 % 40, '-', id div 8000) AS hub").distinct().checkpoint()
    before = shuffled_rows(spark)
    counts = {x["n_common"]: x["pairs"] for x in neighbours.pair_counts(near).collect()}
    pairs = defaultdict(set)
    for x in near.collect():
        pairs[x["hub"]].add(x["a"])
    shared_hubs = Counter(p for nodes in pairs.values() for p in itertools.combinations(sorted(nodes), 2))
    assert counts == Counter(shared_hubs.values())
    assert shuffled_rows(spark) - before < len(shared_hubs) / 2


def test_large_hubs_make_no_pairs_of_nodes_that_differ(spark):
    """Each two of 100,000 leaves have a hub of their own beside the large one: five thousand million pairs are counted, not made."""
    of = "concat('x', id) AS a"
    near = spark.range(100_000).selectExpr(of, "'hub' AS hub").unionByName(spark.range(100_000).selectExpr(of, "concat('h', id div 2) AS hub"))
    assert {x["n_common"]: x["pairs"] for x in neighbours.pair_counts(near).collect()} == {1: 100_000 * 99_999 // 2 - 50_000, 2: 50_000}


def prints(seed):
    r = random.Random(seed)
    base = [r.sample(range(300), r.randint(1, 40)) for _ in range(60)]
    rows = [(i, b) for i, b in enumerate(base)]
    for b in base[:40]:
        for cut in (1, 2, 5):
            rows.append((len(rows), (b + r.sample(range(300), cut))[cut // 2 :]))
    rows += [(1000 + i, list(reversed(base[3]))) for i in range(30)] + [(2000, base[4] + base[4] + [None]), (2001, []), (2002, None), (2003, [None]), (None, base[5]), (None, [7]), (7, base[7]), (2004, [-5, 2**40])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.6, 0.85, 1.0])
def test_tanimoto(spark, threshold):
    rows = prints(4)
    table = spark.createDataFrame(rows, "id long, bits array<long>").repartition(6)
    sets = [(i, frozenset(x for x in b or [] if x is not None)) for i, b in rows]
    classes = defaultdict(list)
    for i, s in sets:
        classes[s].append(i)
    name = {s: min((i for i in ids if i is not None), default=None) for s, ids in classes.items()}
    sim = {(s, t): len(s & t) / len(s | t) for s in classes for t in classes if s and t and s != t}
    near = {k: v for k, v in sim.items() if v >= threshold - 1e-9}
    found = Fingerprints(table)
    got = similar_classes(found, threshold).collect()
    order = lambda a, b: (a, b) if a is not None and b is not None and a < b else (b, a) if a is not None and b is not None else (a if a is not None else b, a if a is not None else b)
    assert Counter((x["a"], x["b"], round(x["similarity"], 6)) for x in got) == Counter((*order(name[s], name[t]), round(v, 6)) for (s, t), v in near.items() if sorted(s) < sorted(t))
    want = Counter()
    for i, s in sets:
        others = [v for (x, _), v in near.items() if x == s]
        n = len(classes[s]) - 1 + sum(len(classes[t]) for (x, t) in near if x == s)
        want[(i, *((name[s], len(s), n, 1.0 if len(classes[s]) > 1 else round(max(others), 6) if others else None) if s else (None, 0, 0, None)))] += 1
    assert Counter(tuple(x) for x in members(found, threshold).collect()) == want
    empty = Fingerprints(table.limit(0))
    assert members(empty, threshold).count() == 0 and similar_classes(empty, threshold).count() == 0
    with pytest.raises(ValueError, match="threshold"):
        similar(found.classes, 0)


def test_only_rare_bits_are_indexed(spark):
    """Bits that all fingerprints have make no candidates where rarer ones decide."""
    table = spark.createDataFrame([(i, [*range(20), *(1000 * k + i for k in range(1, 7))]) for i in range(400)], "id long, bits array<long>")
    classes = Fingerprints(table).classes
    assert candidates(classes, 0.8).count() == 0 and similar(classes, 0.6).count() == 400 * 399 // 2


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.85])
def test_clusters(spark, threshold):
    """As the components of all pairs, with a large group of near copies, hubs that aren't like the rest and chains of likeness."""
    r = random.Random(7)
    rows = prints(9) + [(3000 + i, [*range(1000, 1030), 2000 + i, 2500 + i % 7]) for i in range(150)] + [(4000 + i, list(range(5000 + i, 5020 + i))) for i in range(40)] + [(2999, [1000, *range(9000, 9025)])]
    r.shuffle(rows)
    classes = Fingerprints(spark.createDataFrame(rows, "id long, bits array<long>").repartition(5)).classes
    want = {x["node"]: x["component"] for x in connected_components(similar(classes, threshold), "x", "y").collect()}
    assert {x["key"]: x["component"] for x in clusters(classes, threshold).collect()} == want and len(set(want.values())) > 3
    assert clusters(classes.limit(0), threshold).count() == 0


def test_pairs_are_told_where_they_meet(spark, monkeypatch):
    """Pairs that share several indexed bits come once, without being shuffled to be made distinct, and entries of more than a block lose none."""
    from evgraph.operators import similarity as module

    monkeypatch.setattr(module, "BLOCK", 3)
    rng = random.Random(5)
    sets = {i: frozenset(rng.sample(range(14), rng.randint(2, 7))) for i in range(150)}
    rows = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id int, bits array<int>")
    found = Fingerprints(rows)
    pairs = similar_classes(found, 0.5)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join")[0] and "Deduplicate" not in plan  # nothing is collapsed above the join
    first = {}
    for i, s in sets.items():
        first.setdefault(s, i)
    want = Counter((i, j) for s, i in first.items() for t, j in first.items() if i < j and len(s & t) >= 0.5 * len(s | t) - 1e-9)
    assert Counter((r["a"], r["b"]) for r in pairs.collect()) == want and len(want) > 300
    n = {r["id"]: r["n_similar"] for r in members(found, 0.5).collect()}
    assert n == {i: sum(len(s & t) >= 0.5 * len(s | t) - 1e-9 for t in sets.values()) - 1 for i, s in sets.items()}
