"""Evidence formulas as Column expressions. Nulls are guarded before values are clamped."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.schema import DOMAIN_MULTIPLIER, EVIDENCE_STRENGTH, INGESTION_THRESHOLD, SOURCE_AUTHORITY, TIERS

CURRENT_YEAR = 2026


def looked_up(key: Column, table: dict, default) -> Column:
    """Value of a small constant table; the default where the key is unknown or null."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(key, F.lit(""))), F.lit(default))


def rounded(x: Column) -> Column:
    """To four digits, halves up, whatever the last bits of a sum say."""
    return F.round(F.round(x, 10), 4)


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def age(year: Column, current_year: int) -> Column:
    return F.greatest(F.lit(0), F.lit(current_year) - year)


def source_authority(source_type: Column, year: Column, current_year: int = CURRENT_YEAR) -> Column:
    base = looked_up(source_type, SOURCE_AUTHORITY, 0.50)
    aged = F.least(F.lit(1.0), base / F.log(age(year, current_year) + F.lit(math.e)))
    return rounded(F.when(year.isNull(), base).otherwise(aged))


def edge_evidence_strength(evidence_type: Column) -> Column:
    return looked_up(evidence_type, EVIDENCE_STRENGTH, 0.50)


def assertion_strength(adj_p: Column, effect: Column, replicates: Column, n: Column) -> Column:
    def points(*cases: tuple[Column, int]) -> Column:
        out = F.when(*[cases[0][0], F.lit(cases[0][1])])
        for cond, value in cases[1:]:
            out = out.when(cond, F.lit(value))
        return out.otherwise(F.lit(0))

    total = (
        points((adj_p <= 0.01, 2), (adj_p <= 0.05, 1)) + points((F.abs(effect) >= 1, 2), (F.abs(effect) >= 0.5, 1))
        + points((replicates >= 3, 1)) + points((n >= 10, 1))
    )
    return F.when(total >= 6, 1.0).when(total >= 4, 0.80).when(total >= 2, 0.55).otherwise(0.20)


def aggregate(effect: Column, adj_p: Column, n: Column, weights: tuple[float, float, float] = (0.40, 0.40, 0.20)) -> Column:
    e = F.when(effect.isNull(), 0.0).otherwise(clamp(F.abs(effect) / 2))
    p = F.when(adj_p.isNull() | (adj_p <= 0), 0.0).otherwise(clamp(-F.log10(F.greatest(adj_p, F.lit(1e-300))) / 10))
    s = F.when(n.isNull(), 0.0).otherwise(clamp(F.log10(n + F.lit(1.0)) / 4))
    return rounded(weights[0] * e + weights[1] * p + weights[2] * s)


def recency(year: Column, domain: Column, current_year: int = CURRENT_YEAR) -> Column:
    rate = looked_up(domain, DOMAIN_MULTIPLIER, DOMAIN_MULTIPLIER["general"]) * 0.05
    return rounded(F.when(year.isNull(), 0.5).otherwise(F.exp(-rate * age(year, current_year))))


def replication(datasets: Column, least: int = 2) -> Column:
    """Aggregate: share of rows with `least` data sets or more."""
    return rounded(F.coalesce(F.avg(F.when(datasets >= least, 1.0).otherwise(0.0)), F.lit(0.0)))


def conflict(pos: Column, neg: Column) -> Column:
    return rounded(F.when(pos + neg == 0, 0.0).otherwise(1 - F.try_divide(F.abs(pos - neg).cast("double"), (pos + neg).cast("double"))))


def direction_score(pos: Column, neg: Column) -> Column:
    return rounded(F.when(pos + neg == 0, 0.0).otherwise(F.try_divide((pos - neg).cast("double"), (pos + neg).cast("double"))))


def conflict_severity(pos: Column, neg: Column) -> Column:
    return rounded(1 - F.abs(direction_score(pos, neg)))


def concordance(pos: Column, neg: Column) -> Column:
    """struct(score, flag)."""
    score = F.abs(direction_score(pos, neg))
    flag = F.when(pos + neg == 0, "CONTRADICTORY").when(score >= 0.50, "CONCORDANT").when(score >= 0.30, "CONTEXT_DEPENDENT").otherwise("CONTRADICTORY")
    return F.struct(score.alias("score"), flag.alias("flag"))


def saturation(observed: Column, most: Column) -> Column:
    share = F.least(F.lit(1.0), F.try_divide(observed.cast("double"), most.cast("double")))
    return rounded(F.when(most.isNull() | (most <= 0) | observed.isNull(), 0.0).otherwise(F.log(1 + 5 * share) / math.log(6)))


def consolidated(sa: Column, es: Column, rec: Column, rep: Column, weights: tuple[float, float, float, float] = (0.30, 0.25, 0.35, 0.10)) -> Column:
    if abs(sum(weights) - 1) > 0.001:
        raise ValueError(f"weights sum to {sum(weights)}, not 1")
    return rounded(weights[0] * sa + weights[1] * es + weights[2] * rec + weights[3] * rep)


def tier(score: Column) -> Column:
    out = F.when(score > 1, "Tier 4")
    for name, least in TIERS:
        out = out.when(score >= least, name)
    return out.otherwise("Tier 4")


def passes_ingestion(score: Column) -> Column:
    return score > INGESTION_THRESHOLD


def promotion(es: Column, confidence: Column, effect: Column) -> Column:
    """struct(decision, strength)."""
    decision = F.when((es >= 0.80) & (confidence >= 0.90), "AUTOMATIC").when(es < 0.55, "REJECTED").otherwise("REVIEW")
    return F.struct(decision.alias("decision"), rounded(F.least(F.lit(1.0), F.abs(effect) / 2)).alias("strength"))


def mechanism_confidence(c: Column, ds: Column, r: Column, p: Column, k: Column) -> Column:
    return rounded(0.25 * c + 0.25 * ds + 0.20 * r + 0.15 * p - 0.15 * k)


def mechanism_risk(r: Column, p: Column, k: Column) -> Column:
    return rounded(0.40 * k + 0.35 * (1 - r) + 0.25 * p)


def score_edges(edges: DataFrame, current_year: int = CURRENT_YEAR) -> DataFrame:
    """Adds the score bundle to edges that have effect_size, adj_p, n, pos_count, neg_count, publication_year, domain, evidence_type,
    source_type and both end labels, and leaves out what the ingestion filter rejects."""
    c = F.col
    count = c("pos_count") + c("neg_count")
    agree = concordance(c("pos_count"), c("neg_count"))
    scored = edges.withColumn("edge_aggregate_score", aggregate(c("effect_size"), c("adj_p"), c("n"))).where(passes_ingestion(c("edge_aggregate_score")))
    return scored.withColumns({
        "SA": source_authority(c("source_type"), c("publication_year"), current_year),
        "ES_edge": edge_evidence_strength(c("evidence_type")),
        "ES_assertion": assertion_strength(c("adj_p"), c("effect_size"), count, c("n")),
        "edge_quality_tier": tier(c("edge_aggregate_score")),
        "recency": recency(c("publication_year"), c("domain"), current_year),
        "evidence_count": count,
        "replication_score": rounded(F.least(F.lit(1.0), count / 6)),
        "conflict_score": conflict(c("pos_count"), c("neg_count")),
        "concordance_score": agree["score"],
        "concordance_flag": agree["flag"],
        "edge_class": F.concat_ws("_", "from_label", "_type", "to_label"),
    })


#: Version of the formulas above, as scored edges carry it.
FORMULA_VERSION = "v2.0"


def edge_bundle(scored: DataFrame, relations: DataFrame) -> DataFrame:
    """Adds what else an edge carries beside its scores: direction (its own, else its relation's default, else 0), modality, observed_families, dataset_ids and
    assertion_ids (its own, else null or empty) and formula_version. relations: (type, from_label, to_label, direction_default), one row for each triple."""
    triple = ["_type", "from_label", "to_label"]
    own = lambda c, kind: F.col(c).cast(kind) if c in scored.columns else F.lit(None).cast(kind)
    ids = lambda c: F.coalesce(own(c, "array<string>"), F.array().cast("array<string>"))
    given = scored.withColumns({"direction": own("direction", "int"), "modality": own("modality", "string"), "observed_families": own("observed_families", "long"), "dataset_ids": ids("dataset_ids"), "assertion_ids": ids("assertion_ids"), "formula_version": F.lit(FORMULA_VERSION)})
    defaults = relations.select(F.col("type").alias("_type"), "from_label", "to_label", F.col("direction_default").cast("int").alias("_default"))
    return given.join(defaults, triple, "left").withColumn("direction", F.coalesce("direction", "_default", F.lit(0))).drop("_default").select(*given.columns)
