"""Best paths, betweenness, roles and separation against brute force."""

import itertools
import math
import pathlib
import random
from collections import Counter, defaultdict, deque

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from evgraph.operators import centrality
from evgraph.operators.paths import best_paths, biomarker_scores, trait_scores
from evgraph.plans import fixture_graph as fx
from evgraph.plans import registry

EDGE = "_from string, _type string, _to string, ES_edge double, s string, node string, product int"


def random_edges(seed, n=14, m=45):
    r = random.Random(seed)
    rows = [(f"v{r.randrange(n)}", "E", f"v{r.randrange(n)}", r.choice((0.2, 0.5, 0.9, 1.0, round(r.random(), 3) or 0.1)), "x", "x", 1) for _ in range(m)]
    return [*rows, rows[0], (None, "E", "v1", 1.0, "x", "x", 1), ("v1", "E", None, 1.0, "x", "x", 1), ("v2", "E", "v2", 1.0, "x", "x", 1), ("far", "E", "away", 0.5, "x", "x", 1)]


def brute_paths(rows, starts, most):
    step = defaultdict(dict)
    for a, _, b, s, *_ in rows:
        if a and b and a != b and s and s > 0:
            step[a][b] = max(s, step[a].get(b, 0))
    best = {}
    for start in starts:
        todo = [(start, 0, 1.0, (start,))]
        while todo:
            v, hops, p, seen = todo.pop()
            if hops:
                best[start, v] = max(best.get((start, v), (-1, 0)), (p / hops, -hops))
            if hops < most:
                todo += [(w, hops + 1, p * s, (*seen, w)) for w, s in step[v].items() if w not in seen]
    return {k: (-h, s) for k, (s, h) in best.items()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("most", [1, 4])
def test_best_paths(spark, seed, most):
    rows = [*random_edges(seed), ("v3", "E", "v4", None, "x", "x", 1), ("v3", "E", "v5", 0.0, "x", "x", 1), ("v3", "E", "v6", -1.0, "x", "x", 1)]
    edges = spark.createDataFrame(rows, EDGE).repartition(4)
    names = [f"v{i}" for i in range(14)]
    starts = spark.createDataFrame([(x,) for x in [*names, names[0], None, "nowhere"]], "start string")
    want = brute_paths(rows, names, most)
    got = {(x["start"], x["node"]): (x["hops"], x["score"]) for x in best_paths(edges, starts, most).collect()}
    assert got.keys() == want.keys() and all(g[0] == want[k][0] and math.isclose(g[1], want[k][1], rel_tol=1e-12) for k, g in got.items())
    some = {(x["start"], x["node"]) for x in best_paths(edges, starts, most, least=0.2).collect()}
    assert some == {k for k, (_, s) in want.items() if s >= 0.2} and len(some) < len(want)
    assert best_paths(edges.limit(0), starts, most).count() == 0 and best_paths(edges, starts.limit(0), most).count() == 0


def test_a_strength_above_one_is_an_error(spark):
    edges = spark.createDataFrame([("a", "E", "b", 1.5, "", "", 1)], EDGE)
    with pytest.raises(Exception, match="strength is above 1"):
        best_paths(edges, spark.createDataFrame([("a",)], "start string")).collect()


def brute_betweenness(rows, sources=None, most=None):
    near = defaultdict(set)
    for a, _, b, *_ in rows:
        if a and b and a != b:
            near[a].add(b)
            near[b].add(a)
    out = dict.fromkeys(near, 0.0)
    starts = [s for s in near if sources is None or s in sources]
    for s in starts:
        dist, paths, order, todo = {s: 0}, Counter({s: 1}), [], deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist and (most is None or dist[v] < most):
                    dist[w] = dist[v] + 1
                    todo.append(w)
                if dist.get(w) == dist[v] + 1:
                    paths[w] += paths[v]
        depends = Counter()
        for w in reversed(order):
            for v in near[w]:
                if dist.get(v) == dist[w] - 1:
                    depends[v] += paths[v] / paths[w] * (1 + depends[w])
            if w != s:
                out[w] += depends[w]
    return {v: x * len(near) / (2 * len(starts)) for v, x in out.items()}


def same(got, want):
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


@pytest.mark.parametrize("seed", [3, 4])
def test_betweenness(spark, seed):
    rows = random_edges(seed, n=16, m=24)
    edges = spark.createDataFrame(rows, EDGE).repartition(3)
    all_of = lambda df: {x["node"]: x["betweenness"] for x in df.collect()}
    same(all_of(centrality.betweenness(edges)), brute_betweenness(rows))
    some = ["v1", "v2", "v7", "far", "nowhere"]
    chosen = spark.createDataFrame([(x,) for x in [*some, "v1", None]], "node string")
    same(all_of(centrality.betweenness(edges, chosen)), brute_betweenness(rows, some))
    same(all_of(centrality.betweenness(edges, chosen, most=2)), brute_betweenness(rows, some, 2))
    assert centrality.betweenness(edges.limit(0)).count() == 0
    assert set(all_of(centrality.betweenness(edges, chosen.limit(0))).values()) == {0.0}


def test_quantiles_and_roles(spark):
    r = random.Random(6)
    values = [round(r.gauss(0, 5), 2) for _ in range(500)] + [1.25] * 300 + [1e9, -1e9, 1e-300]
    table = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    for share in (0.0, 0.1, 0.5, 0.9, 0.999, 1.0):
        rank = max(1, math.ceil(round(share * len(values), 9)))
        assert centrality.exact_quantile(table, "v", share, buckets=8) == sorted(values)[rank - 1]
    assert centrality.exact_quantile(table.limit(0), "v", 0.5) is None
    rows = random_edges(8)
    edges = spark.createDataFrame(rows, EDGE)
    got = {x["node"]: x.asDict() for x in centrality.role_matrix(edges, centrality.betweenness(edges).withColumn("betweenness", F.round("betweenness", 6)), share=0.7).collect()}
    near = {frozenset((a, b)) for a, _, b, *_ in rows if a and b and a != b}
    degree, between = Counter(itertools.chain(*near)), brute_betweenness(rows)
    at = lambda xs: sorted(round(x, 6) for x in xs)[math.ceil(round(0.7 * len(degree), 9)) - 1]
    many, central = at(degree.values()), at(between.values())
    role = {(True, True): "hub", (True, False): "local hub", (False, True): "structural bottleneck", (False, False): "peripheral"}
    assert {n: x["role"] for n, x in got.items()} == {n: role[degree[n] >= many, round(between[n], 6) >= central] for n in degree}


def test_separation(spark):
    rows = [("a", "b", True, False), ("b", "a", False, True), ("a", "c", True, None), ("a", "a", True, True), ("c", "d", False, True), ("e", "f", False, False), (None, "a", True, True), ("a", "b", True, False)]
    table = spark.createDataFrame(rows, "_from string, _to string, ill boolean, well boolean")
    got = {x["node"]: (x["first"], x["second"], x["separation"]) for x in centrality.separation(table, "ill", "well").collect()}
    third = 1 / 3
    assert {k: tuple(round(v, 9) for v in x) for k, x in got.items()} == {k: tuple(round(v, 9) for v in x) for k, x in {"a": (1.0, third, 1 - third), "b": (0.5, third, 0.5 - third), "c": (0.5, third, 0.5 - third), "d": (0.0, third, third)}.items()}
    assert centrality.separation(table.limit(0), "ill", "well").count() == 0
    only = centrality.separation(table.where(F.col("ill")), "ill", "well").collect()
    assert {x["second"] for x in only if x["node"] == "c"} == {0.0}


def test_trait_and_biomarker_scores(spark):
    loci = spark.createDataFrame([("g", "a", 0.01), ("g", "a", 0.0001), ("g", "b", 0.1), ("h", "b", 0.0), ("h", "a", None), ("k", "c", 1e-9)], "_from string, _to string, adj_p double")
    reach = spark.createDataFrame([("a", "x", 1, 0.5, 0.5), ("b", "x", 1, 0.9, 0.9), ("b", "y", 2, 0.8, 0.4)], "start string, node string, hops int, product double, score double")
    assert {(x["_from"], x["node"]): round(x["score"], 9) for x in trait_scores(loci, reach).collect()} == {("g", "x"): 2.0, ("g", "y"): 0.4}
    influence = spark.createDataFrame([("a", 4.0), ("b", 1.0), ("z", 2.0)], "node string, influence double")
    evidence = spark.createDataFrame([("a", 0.2), ("a", 0.6), ("b", 1.0), ("b", None)], "node string, ES_edge double")
    assert {x["node"]: round(x["score"], 9) for x in biomarker_scores(influence, reach, evidence).collect()} == {"a": 0.2, "b": 0.225}
    assert {x["score"] for x in biomarker_scores(influence.withColumn("influence", F.lit(0.0)), reach, evidence).collect()} == {0.0}
    assert biomarker_scores(influence.limit(0), reach, evidence).count() == 0 and trait_scores(loci.limit(0), reach).count() == 0


def test_betweenness_in_rounds(spark, monkeypatch):
    """Rounds of a few sources add up to the same; their levels are deleted."""
    monkeypatch.setattr(centrality, "ROWS", 1)
    rows = random_edges(9, n=12, m=20)
    edges = spark.createDataFrame(rows, EDGE)
    at = pathlib.Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    before = set(at.iterdir()) if at.exists() else set()
    found = centrality.betweenness(edges)
    left = set(at.iterdir()) - before
    same({x["node"]: x["betweenness"] for x in found.collect()}, brute_betweenness(rows))
    assert len(left) < 10  # the graph, its numbers and the sum


def test_roles_come_from_all_sources_and_paths(spark):
    net = fx.bulk(spark, SMALL).unionByName(fx.brand_chain(spark, SMALL))
    rows = [(x["_from"], "", x["_to"]) for x in net.select("_from", "_to").collect()]
    degree, between = Counter(itertools.chain(*{frozenset((a, b)) for a, _, b in rows})), {k: round(v, 4) for k, v in brute_betweenness(rows).items()}
    at = lambda xs: sorted(xs)[math.ceil(round(0.9 * len(degree), 9)) - 1]
    many, central = at(degree.values()), at(between.values())
    role = {(True, True): "hub", (True, False): "local hub", (False, True): "structural bottleneck", (False, False): "peripheral"}
    want = Counter((role[degree[n] >= many, between[n] >= central], n.split(":")[0]) for n in degree)
    assert {(x["role"], x["label"]): x["n"] for x in registry.queries()["n01_n02_role_matrix"](spark, SMALL).collect()} == want
