import pytest
from pyspark.sql import functions as F

from evgraph.functions import scoring as s


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lits(*xs):
    kinds = {float: "double", int: "long", str: "string", type(None): "double"}
    return [F.lit(x).cast(kinds[type(x)]) for x in xs]


def test_consolidated(spark):
    x = s.consolidated(*lits(0.95, 0.85, 0.90, 0.80))
    assert value(spark, x) == pytest.approx(0.8925)
    assert value(spark, s.tier(x)) == "Tier 1"
    with pytest.raises(ValueError):
        s.consolidated(*lits(1.0, 1.0, 1.0, 1.0), weights=(0.5, 0.5, 0.5, 0.5))


@pytest.mark.parametrize("kind,year,want", [("peer_reviewed", 2026, 0.85), ("peer_reviewed", None, 0.85), ("unheard", 2026, 0.50), (None, None, 0.50), ("curated_ontology", 2016, 0.3933)])
def test_source_authority(spark, kind, year, want):
    assert value(spark, s.source_authority(F.lit(kind).cast("string"), F.lit(year).cast("int"))) == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("args,want", [((0.001, 1.5, 3, 100), 1.0), ((0.9, 0.01, 1, 2), 0.20), ((0.04, 0.6, 1, 5), 0.55), ((0.001, 0.6, 3, 50), 0.80), ((0.001, 2.0, 4, 500), 1.0), ((None, None, None, None), 0.20), ((None, 1.5, None, 100), 0.55)])
def test_assertion_strength(spark, args, want):
    assert value(spark, s.assertion_strength(*lits(*args))) == want


@pytest.mark.parametrize("args,low,high", [((0.0, 1.0, 0), 0, 0), ((2.0, 1e-12, 10000), 0.9, 1), ((None, None, None), 0, 0), ((2.0, None, None), 0.4, 0.4), ((2.0, 0.0, None), 0.4, 0.4), ((2.0, -1.0, 0), 0.4, 0.4)])
def test_aggregate(spark, args, low, high):
    assert low <= value(spark, s.aggregate(*lits(*args))) <= high


@pytest.mark.parametrize("x,want", [(1.0, 1), (0.85, 1), (0.84, 2), (0.60, 2), (0.59, 3), (0.40, 3), (0.39, 4), (0.0, 4), (1.1, 4)])
def test_tier(spark, x, want):
    assert value(spark, s.tier(F.lit(x))) == f"Tier {want}"


@pytest.mark.parametrize("x,keep", [(0.10, False), (0.05, False), (0.11, True)])
def test_ingestion(spark, x, keep):
    assert value(spark, s.passes_ingestion(F.lit(x))) is keep


@pytest.mark.parametrize("pos,neg,direction,conflict,flag", [(7, 1, 0.75, 0.25, "CONCORDANT"), (5, 5, 0, 1, "CONTRADICTORY"), (10, 0, 1, 0, "CONCORDANT"), (0, 0, 0, 0, "CONTRADICTORY"), (1, 7, -0.75, 0.25, "CONCORDANT"), (7, 4, 0.2727, 0.7273, "CONTRADICTORY"), (2, 1, 0.3333, 0.6667, "CONTEXT_DEPENDENT")])
def test_signs(spark, pos, neg, direction, conflict, flag):
    p, n = lits(pos, neg)
    assert value(spark, s.direction_score(p, n)) == pytest.approx(direction, abs=1e-4)
    assert value(spark, s.conflict(p, n)) == pytest.approx(conflict, abs=1e-4)
    assert value(spark, s.concordance(p, n))["flag"] == flag
    if pos + neg:
        assert value(spark, s.conflict_severity(p, n)) == pytest.approx(conflict, abs=1.01e-4)


def test_saturation_and_recency(spark):
    assert value(spark, s.saturation(*lits(10, 10))) == 1.0
    assert value(spark, s.saturation(*lits(0, 10))) == 0.0
    assert value(spark, s.saturation(*lits(5, 0))) == 0.0
    assert value(spark, s.saturation(*lits(5, None))) == 0.0
    assert value(spark, s.recency(F.lit(2026), F.lit("oncology"))) == 1.0
    assert value(spark, s.recency(F.lit(None).cast("int"), F.lit("oncology"))) == 0.5
    assert value(spark, s.recency(F.lit(2016), F.lit("unheard"))) == pytest.approx(0.6065, abs=1e-4)


@pytest.mark.parametrize("es,conf,want", [(0.8, 0.9, "AUTOMATIC"), (0.8, 0.89, "REVIEW"), (0.54, 1.0, "REJECTED"), (0.55, 0.0, "REVIEW")])
def test_promotion(spark, es, conf, want):
    assert value(spark, s.promotion(F.lit(es), F.lit(conf), F.lit(3.0))).asDict() == {"decision": want, "strength": 1.0}


def test_halves_round_up(spark):
    assert value(spark, s.rounded(F.lit(0.00015))) == 0.0002
    assert value(spark, s.rounded(F.lit(0.1) * 1.6115)) == 0.1612
    assert value(spark, s.mechanism_confidence(*lits(1.0, 1.0, 1.0, 1.0, 0.0))) == 0.85
    assert value(spark, s.mechanism_confidence(*lits(0.0, 0.0, 0.0, 0.0, 1.0))) == -0.15
