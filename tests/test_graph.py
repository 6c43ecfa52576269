import pytest
from pyspark.sql import functions as F

from evgraph.operators import graph, history, migrate
from evgraph.operators.components import connected_components
from evgraph.schema import RETIRED, retirements


def edges(spark, rows):
    return spark.createDataFrame([(a, t, b) for a, t, b in rows], "_from string, _type string, _to string")


def test_components_that_do_not_settle(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long")
    with pytest.raises(RuntimeError, match="2 rounds"):
        connected_components(chain, rounds=2)


def test_components(spark):
    tri = [("a", "E", "b"), ("b", "E", "c"), ("c", "E", "a"), ("x", "E", "y"), ("y", "E", "z"), ("z", "E", "x")]
    e = edges(spark, [*tri, ("a", "T", "x")])
    assert graph.component_summary(e).first().asDict() == {"components": 1, "largest": 6, "covered": 6}
    assert graph.component_summary(e, ["T"]).first().asDict() == {"components": 2, "largest": 3, "covered": 6}
    empty = graph.component_summary(e.limit(0)).first()
    assert (empty["components"], empty["largest"], empty["covered"]) == (0, 0, 0)


def test_long_chain_and_loops(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000}


def test_alternative_paths(spark):
    e = edges(spark, [("a", "T", "b"), ("c", "T", "d"), ("c", "E", "1"), ("1", "E", "2"), ("2", "E", "d"), ("e", "T", "f"), ("e", "E", "3"), ("3", "E", "4"), ("4", "E", "5"), ("5", "E", "6"), ("6", "E", "f")])
    assert graph.alternative_paths(e, "T").first().asDict() == {"pairs": 3, "with_path": 1, "mean_length": 3.0}


def test_hub_reach(spark):
    rows = [(f"s{i}", "A", "hub") for i in range(4)] + [("hub", "B", f"t{i}") for i in range(3)] + [("s9", "A", "dead")]
    assert graph.hub_reach(edges(spark, rows), "A", "B", 6).first().asDict() == {"sources": 5, "reaching": 4, "mean_reach": 3.0, "reach_pct": 50.0}


@pytest.mark.parametrize("pct,length,reach,want", [(80.0, 3.0, 50.0, "NOT CONFIRMED"), (81.0, 2.2, 0.0, "SEVERE"), (81.0, 3.0, 20.1, "SEVERE"), (81.0, 3.0, 20.0, "CONFIRMED BUT BOUNDED")])
def test_verdict(spark, pct, length, reach, want):
    assert spark.range(1).select(graph.gap_verdict(F.lit(pct), F.lit(length), F.lit(reach)).alias("v")).first()["v"] == want


def test_undirected_paths(spark):
    n = spark.createDataFrame([("s", "S"), ("h", "Hub"), ("t1", "T"), ("m", "M"), ("t2", "T")], "uid string, entity_type string")
    e = spark.createDataFrame([("s", "E", "h", "S", "Hub"), ("h", "E", "t1", "Hub", "T"), ("m", "E", "s", "M", "S"), ("m", "E", "t2", "M", "T")], "_from string, _type string, _to string, from_label string, to_label string")
    assert [tuple(r) for r in graph.undirected_paths(e, "s", "T", ["Hub"], n).collect()] == [("t2", 2)]
    assert [tuple(r) for r in graph.undirected_paths(e, "s", "T", [], n).collect()] == [("t1", 2), ("t2", 2)]


def v1(spark):
    rows = [("d1", "TREATS_INDICATION", "x", "Drug", "Disease", 1), ("d1", "CLINICALLY_TREATS", "x", "Drug", "Disease", 2), ("t", "EXPRESSES", "g", "Tissue", "Gene", 3), ("b", "ACTIVATED_BY", "d1", "BiologicalProcess", "Drug", 4), ("b", "SUPPRESSED_BY", "d1", "BiologicalProcess", "Drug", 5), ("g", "CAUSES", "x", "Gene", "Disease", 6), ("b", "CAUSES", "x", "BiologicalProcess", "Disease", 7)]
    return spark.createDataFrame(rows, "_from string, _type string, _to string, from_label string, to_label string, weight int").withColumn("edge_id", F.sha2(F.concat_ws("|", "_from", "_type", "_to"), 256))


def test_migration(spark):
    plan, before = retirements(spark), v1(spark)
    after = migrate.migrate(before, plan)
    got = {(r["_from"], r["_type"], r["_to"]): r["weight"] for r in after.collect()}
    assert got == {("d1", "CLINICALLY_TREATS", "x"): 2, ("g", "EXPRESSED_IN", "t"): 3, ("d1", "PHARMACOLOGICALLY_ACTIVATES", "b"): 4, ("d1", "PHARMACOLOGICALLY_INHIBITS", "b"): 5, ("g", "CAUSES", "x"): 6, ("b", "DRIVES_DISEASE_PATHOLOGY", "x"): 7}
    again = migrate.migrate(after, plan)
    assert sorted(map(str, again.collect())) == sorted(map(str, after.collect()))
    active = spark.createDataFrame([(t,) for t in {r[4] for r in RETIRED}], "type string")
    assert migrate.coverage_problems(before, after, plan, active).count() == 0
    assert {tuple(r) for r in graph.retired_counts(before, plan).collect()} == {("TREATS_INDICATION", 1), ("EXPRESSES", 1), ("ACTIVATED_BY", 1), ("SUPPRESSED_BY", 1), ("CAUSES", 1)}
    assert migrate.impact(before, after, plan).first().asDict() == {"before": 7, "after": 6, "retired": 5, "removed": 1, "removed_pct": 14.29}


def test_no_triple_is_retired_twice():
    triples = [r[1:4] for r in RETIRED]
    assert len(triples) == len(set(triples)) == 31


def test_history(spark):
    rows = [("h", i + 1, v) for i, v in enumerate([0.1, 0.2, 0.2, 0.6, 0.61, 0.62])] + [("one", 1, 0.5)]
    got = {(r["hypothesis_id"], r["Hv"]): r for r in history.with_changes(spark.createDataFrame(rows, "hypothesis_id string, Hv int, MC double")).collect()}
    assert got["h", 1]["delta_MC"] is None and got["h", 1]["stability"] == 1.0 and got["one", 1]["stability"] == 1.0
    assert got["h", 4]["delta_MC"] == 0.4 and got["h", 4]["stability"] == pytest.approx(1 - (0.5 / 3) / 0.2, abs=1e-4)
    assert got["h", 6]["stability"] == pytest.approx(max(0, 1 - (0.0 + 0.4 + 0.01 + 0.01) / 4 / 0.2), abs=1e-4)


def test_components_broadcast_nothing(spark):
    """Nothing is gathered in the driver, where tables are small enough for it, either."""
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "src long, dst long")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    try:
        assert {r["component"] for r in connected_components(chain).collect()} == {0}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
