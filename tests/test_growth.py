"""Steps whose tasks or passes grew faster than their input: plans without them, and the same rows as before."""

from conftest import SMALL
from pyspark.sql import functions as F
from test_centrality import EDGE, brute_paths, random_edges

from evgraph.operators import contract, paths
from evgraph.operators.components import connected_components
from evgraph.operators.paths import best_paths, trait_scores
from evgraph.plans import registry
from evgraph.sources import seeds


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_specs_are_broadcast(spark):
    """Nodes are judged where they are read, not in a task for each label."""
    rows = spark.createDataFrame([("Customer", "1", "n", "c"), ("Region", "2", "n", "c"), ("Nation", " ", "n", "c")], "entity_type string, canonical_id string, name string, category string")
    judged = contract.judged_nodes(rows, registry.label_specs(spark))
    assert "BroadcastHashJoin" in judged._jdf.queryExecution().sparkPlan().toString()
    assert {r["entity_type"]: r["reasons"] for r in judged.collect()} == {"Customer": [], "Region": ["unknown label"], "Nation": ["empty canonical id"]}
    good, bad = contract.split_nodes(rows, registry.label_specs(spark))
    assert [r["entity_type"] for r in good.collect()] == ["Customer"] and bad.count() == 2


def test_edges_are_judged_in_one_pass(spark):
    assert optimized(registry.queries()["c5_edge_rejections"](spark, SMALL)).count("Join ") == 1

def test_memberships_are_distinct_before_they_are_edges(spark):
    rows = spark.createDataFrame([("a", "p", "1"), ("a", "q", "1"), ("a", "q", "1"), (None, "p", "2"), ("b", None, "2"), ("b", "p", None)], "gene_symbol string, protein_id string, pathway_id string")
    edges = seeds.membership_edges(rows)
    keys = [x.split("Aggregate [")[1].split("]")[0] for x in optimized(edges).splitlines() if "Aggregate [" in x]
    assert len(keys) == 2 and not any("_from" in k for k in keys)
    got = [tuple(r) for r in edges.collect()]
    g, p = "PARTICIPATES_IN", "PROTEIN_PARTICIPATES_IN"
    assert sorted(got, key=str) == sorted([("Gene:a", g, "Pathway:1"), ("Gene:b", g, "Pathway:2"), ("Gene:b", g, None), ("Protein:p", p, "Pathway:1"), ("Protein:q", p, "Pathway:1"), ("Protein:p", p, "Pathway:2"), ("Protein:p", p, None)], key=str)


def test_scores_are_shuffled_as_lists(spark):
    """No row for each trait and node is shuffled, and paths need no sort for their best hops."""
    edges = spark.createDataFrame([("s", "a", 0.9), ("s", "b", 1.0), ("t", "b", 0.95)], "_from string, _to string, ES_edge double")
    loci = spark.createDataFrame([("x", "s", 1e-12), ("x", "t", 1e-20), ("y", "t", 1e-11), ("y", "s", 0.0)], "_from string, _to string, adj_p double")
    reach = best_paths(edges, loci.select(F.col("_to").alias("start")), most=1)
    found = trait_scores(loci, reach)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_from" in plan and not any("Exchange hashpartitioning" in x and "node" in x for x in plan.splitlines())
    assert "SortAggregate" not in reach._jdf.queryExecution().executedPlan().toString()
    assert {(r["_from"], r["node"]): round(r["score"], 6) for r in found.collect()} == {("x", "a"): 10.8, ("x", "b"): 19.0, ("y", "b"): 10.45}


def test_paths_ship_states_once_a_level(spark):
    """What a level finds is shuffled once, by its node alone, and never checkpointed; edges that no path can take further are not met again."""
    edges = spark.createDataFrame([("s", "a", 0.9), ("s", "b", 1.0), ("t", "b", 0.95), ("a", "b", 0.5), ("b", "c", 0.9), ("c", "d", 1.0)], "_from string, _to string, ES_edge double")
    starts = spark.createDataFrame([("s",), ("t",)], "start string")
    reach = best_paths(edges, starts, most=3)
    states = [x for x in optimized(reach).splitlines() if "LogicalRDD" in x]
    assert not any("start" in x and "p1" in x for x in states)
    got = {(r["start"], r["node"]): (r["hops"], round(r["score"], 6)) for r in reach.collect()}
    assert got == {("s", "a"): (1, 0.9), ("s", "b"): (1, 1.0), ("s", "c"): (2, 0.45), ("s", "d"): (3, 0.3), ("t", "b"): (1, 0.95), ("t", "c"): (2, 0.4275), ("t", "d"): (3, 0.285)}
    plan = reach._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and not any("Exchange hashpartitioning(start" in x and "node" in x.split("Exchange", 1)[1] for x in plan.splitlines())


def test_paths_of_many_groups_and_levels(spark, monkeypatch):
    monkeypatch.setattr(paths, "GROUP", 3)
    rows, names = random_edges(5), [f"v{i}" for i in range(14)]
    reach = best_paths(spark.createDataFrame(rows, EDGE), spark.createDataFrame([(x,) for x in names], "start string"), most=6)
    want = brute_paths(rows, names, 6)
    got = {(r["start"], r["node"]): (r["hops"], r["score"]) for r in reach.collect()}
    assert got.keys() == want.keys() and all(g[0] == want[k][0] and abs(g[1] - want[k][1]) < 1e-12 for k, g in got.items())


def test_rounds_do_not_carry_guessed_sizes(spark):
    """A join's guessed size is the product of both sides; carried through checkpoints, its digits doubled with each join of a round and filled the driver."""
    chain = spark.createDataFrame([(f"v{i:03}", f"v{i + 1:03}") for i in range(99)], "src string, dst string")
    found = connected_components(chain)
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 1000  # whole numbers
    assert {r["component"] for r in found.collect()} == {"v000"} and found.count() == 100
