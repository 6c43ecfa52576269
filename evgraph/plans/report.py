"""Manifest aggregates, capability checks and readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.operators.components import ensure_checkpoint_dir


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    """(dimension, value, n) of each column in one pass; nulls dropped."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def split_totals(rows: DataFrame) -> DataFrame:
    """total, real, synthetic and their percentages."""
    synthetic = F.coalesce(F.sum(F.when(F.col("is_synthetic"), 1).otherwise(0)), F.lit(0))
    one = rows.agg(F.count("*").alias("total"), synthetic.alias("synthetic")).withColumn("real", F.col("total") - F.col("synthetic"))
    pct = lambda c: F.round(100.0 * F.col(c) / F.greatest(F.col("total"), F.lit(1)), 2)
    return one.select("total", "real", "synthetic", pct("real").alias("real_pct"), pct("synthetic").alias("synthetic_pct"))


def cluster_volume(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """Edges between label clusters, counted for each endpoint pair. clusters(label, cluster): a row for each label."""
    rows = edges.join(clusters.select(F.col("label").alias("from_label"), F.col("cluster").alias("a")), "from_label").join(clusters.select(F.col("label").alias("to_label"), F.col("cluster").alias("b")), "to_label")
    return rows.groupBy("a", "b").agg(F.count("*").alias("n"))


def profile(edges: DataFrame, layer: str) -> DataFrame:
    """labels in use, endpoint pairs, types, pairs of a layer, edges."""
    triple = F.struct("_type", "from_label", "to_label")
    labels = edges.select(F.explode(F.array("from_label", "to_label")).alias("l")).agg(F.countDistinct("l").alias("labels"))
    return edges.agg(F.countDistinct(triple).alias("pairs"), F.countDistinct("_type").alias("types"), F.countDistinct(F.when(F.col("layer") == layer, triple)).alias("layer_pairs"), F.count("*").alias("edges")).crossJoin(labels)  # single rows


# ---------------------------------------------------------------- capabilities

#: Why two capabilities can't be had from a property graph alone.
UNSUPPORTED = {"agriculture_data": "no entity types for agriculture", "embeddings": "no vector layer"}


QTL = ("eQTL_MODULATES", "pQTL_MODULATES", "mQTL_MODULATES")


class Checks:
    """Conditional aggregates of all checks; roles may be played by other labels, types and properties."""

    def __init__(self, nodes: DataFrame, edges: DataFrame, names: dict[str, str] | None = None):
        self.nodes, self.edges, self.names = nodes, edges, names or {}

    def name(self, role: str) -> str:
        return self.names.get(role, role)

    def of(self, rows: DataFrame, role: str) -> Column:
        c = self.name(role)
        return F.col(c) if c in rows.columns else F.lit(None)

    def node_aggregates(self) -> dict[str, Column]:
        n = self.nodes
        c = lambda r: self.of(n, r)
        is_ = lambda r: n["entity_type"] == self.name(r)
        num = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
        whole = lambda label, *rs: num(is_(label) & _all(*[c(r).isNotNull() for r in rs]))
        missing = lambda *rs: num(~_all(*[c(r).isNotNull() for r in rs]))
        return {
            "nodes": F.count("*"), "bad_metadata": missing("entity_type", "canonical_id", "synonyms", "ontology_refs", "created_at"), "bad_provenance": missing("source", "is_synthetic", "valid_from", "updated_at"),
            "datasets": num(is_("Dataset")), "cohorts": num(is_("Cohort")), "assertions": num(is_("Assertion")),
            "evidence": num(is_("Evidence")), "staged": whole("Evidence", "disease_stage"), "batches": whole("Evidence", "batch_id", "platform", "lab_id"),
            "clinical": num(is_("Evidence") & (c("is_clinical").cast("boolean"))), "publications": num(is_("Publication")),
            "variants": whole("Variant", "chromosome", "base_position", "p_raw", "effect_weight"), "species": num(is_("Species")), "hypotheses": whole("Hypothesis", "biological_domain", "decision_context"),
            "deltas": whole("HypothesisVersion", "delta_MC"), "converged": num(is_("HypothesisVersion") & (F.abs(c("delta_MC").cast("double")) < 0.02)),
            "components": whole("ConfidenceScore", "component_C", "component_dS", "component_R", "component_P", "component_K"), "chains": whole("ReasoningChain", "path_traceability"),
            "states": whole("BiologicalState", "snapshot_hash"), "results": whole("ScanResult", "Dv", "Tv", "Hv", "snapshot_hash"), "events": num(is_("AuditEvent")), "tissues": num(is_("Tissue")), "cell_types": num(is_("CellType")), "compounds": whole("Compound", "morgan_fp"),
        }

    def node_kinds(self) -> dict[str, Column]:
        """Properties of which different values are counted."""
        of = lambda label, r: F.when(self.nodes["entity_type"] == self.name(label), self.of(self.nodes, r).cast("string"))
        return {
            "cohort_states": of("Cohort", "cohort_state"), "decisions": of("Assertion", "promotion_decision"), "evidence_modalities": of("Evidence", "modality"), "stages": of("Evidence", "disease_stage"),
            "publication_types": of("Publication", "source_type"), "lifecycle_states": of("LifecycleState", "name"), "event_types": of("AuditEvent", "event_type"),
            "domains": F.when(self.of(self.nodes, "decision_context").isNotNull(), of("Hypothesis", "biological_domain")),
        }

    def edge_kinds(self) -> dict[str, Column]:
        kinds = {k: self.of(self.edges, r).cast("string") for k, r in (("tiers", "edge_quality_tier"), ("modalities", "modality"), ("years", "publication_year"))}
        return kinds | {"qtl_kinds": F.when(self.edges["_type"].isin(*map(self.name, QTL)), self.edges["_type"])}

    def edge_aggregates(self) -> dict[str, Column]:
        e = self.edges
        c = lambda r: self.of(e, r)
        num = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
        kind = lambda *rs: e["_type"].isin(*[self.name(r) for r in rs])
        ends = lambda a, b: (e["from_label"] == self.name(a)) & (e["to_label"] == self.name(b))
        return {
            "edges": F.count("*"), "scored": num(_all(*[c(r).isNotNull() for r in ("SA", "ES_edge", "edge_aggregate_score")])), "tiered": F.count(c("edge_quality_tier")),
            "conflicts": num(c("pos_count").isNotNull() & (c("neg_count") > 0)), "directed": num(c("direction").isin(-1, 1)), "traced": num(_all(*[c(r).isNotNull() for r in ("dataset_ids", "source_type", "publication_year", "formula_version")])),
            "year_lo": F.min(c("publication_year").cast("int")), "year_hi": F.max(c("publication_year").cast("int")),
            "locus": num(kind("MAPS_TO_LOCUS") & ends("Variant", "Gene")), "modal": F.count(c("modality")), "qtl": num(kind(*QTL)), "conserved": num(kind("ORTHOLOG_OF", "CONSERVED_IN")),
            "memberships": num(kind("HYPOTHESIS_INCLUDES_NODE") & (e["from_label"] == self.name("Hypothesis"))), "hierarchy": num(kind("ONTOLOGICALLY_INCLUDES") & ends("OntologyTerm", "OntologyTerm")),
            "signed_drugs": num(kind("PHARMACOLOGICALLY_ACTIVATES", "PHARMACOLOGICALLY_INHIBITS")), "off_targets": num(kind("EXERTS_OFF_TARGET_EFFECT", "OFF_TARGET_INTERACTION")), "encodes": num(kind("ENCODES") & ends("Gene", "Protein")),
        }


def _all(*conds: Column) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def different(rows: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """One row: the number of different values of each property. Values are collapsed in each task first; several distinct counts in one
    aggregate would multiply all rows instead."""
    named = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in kinds.items()])
    pairs = rows.select(F.explode(F.filter(named, lambda x: x["v"].isNotNull())).alias("x")).select("x.k", "x.v").distinct()
    return pairs.agg(*[F.count_if(F.col("k") == k).alias(k) for k in kinds])


def rules(figures: set[str]) -> list[tuple[str, str, Column, Column]]:
    """(capability, description, passes, detail) over the joined aggregates."""
    c, s = F.col, lambda *xs: F.concat(*[F.format_number(F.col(x), 0) if x in figures else F.lit(x) for x in xs])
    least = lambda k, n, *d: (c(k) >= n, s(k, *d))
    out = {
        "topology": ("enough nodes and directed edges to traverse", (c("nodes") > 100) & (c("edges") > 500), F.when(c("edges") > 0, s("nodes", " nodes / ", "edges", " edges"))),
        "node_metadata": ("mandatory fields on every node", c("bad_metadata") == 0, s("bad_metadata", " nodes lack fields")),
        "provenance_fields": ("provenance and validity on every node", c("bad_provenance") == 0, s("bad_provenance", " nodes lack fields")),
        "edge_scores": ("scored edges", *least("scored", 500, " scored edges")), "edge_tiers": ("tiers span more than one band", c("tiers") >= 2, s("tiers", " tiers over ", "tiered", " edges")),
        "edge_conflict": ("counts for and against", *least("conflicts", 100, " edges with contradiction")), "edge_direction": ("signed edges", *least("directed", 100, " directional edges")),
        "edge_provenance": ("provenance of edges", *least("traced", 500, " edges with full provenance")), "edge_modality": ("modalities", *least("modalities", 3, " modalities over ", "modal", " edges")),
        "edge_recency": ("spread of years", c("years") >= 8, F.concat(s("years", " distinct years ("), c("year_lo").cast("string"), F.lit("-"), c("year_hi").cast("string"), F.lit(")"))), "datasets": ("data sets", *least("datasets", 10, " data sets")), "cohorts": ("paired cohorts", c("cohort_states") >= 2, s("cohorts", " cohorts, ", "cohort_states", " states")),
        "assertions": ("assertions with decisions", (c("assertions") > 50) & (c("decisions") >= 2), s("assertions", " assertions, ", "decisions", " decisions")), "evidence_modality": ("modalities of evidence", c("evidence_modalities") >= 4, s("evidence_modalities", " modalities / ", "evidence", " records")),
        "evidence_stage": ("stages of evidence", *least("stages", 2, " stages / ", "staged", " records")), "evidence_batch": ("batch, platform and lab", *least("batches", 50, " with batch data")), "clinical_evidence": ("clinical evidence", *least("clinical", 10, " clinical records")),
        "publications": ("publications", c("publications") > 50, s("publications", " publications, ", "publication_types", " types")), "variant_stats": ("variants with all attributes", *least("variants", 100, " variants")), "variant_locus": ("variants mapped to loci", *least("locus", 10, " edges")),
        "qtl": ("trait loci", c("qtl") > 50, s("qtl", " edges, ", "qtl_kinds", " kinds")), "orthologs": ("conservation across species", (c("species") >= 2) & (c("conserved") > 10), F.when(c("conserved") > 0, s("species", " species, ", "conserved", " edges"))),
        "hypotheses": ("hypotheses with context", *least("hypotheses", 10, " hypotheses, ", "domains", " domains")), "hypothesis_subgraph": ("typed membership", *least("memberships", 20, " edges")), "version_history": ("two versions or more", c("with_history") >= 5, F.when(c("with_history") > 0, F.concat(s("with_history", " hypotheses with history (avg "), F.format_number("avg_versions", 1), F.lit(" versions)")))),
        "mc_trajectory": ("changes, some of them converged", (c("deltas") > 20) & (c("converged") > 0), s("deltas", " changes, ", "converged", " converged")), "confidence_components": ("all five components", *least("components", 5, " sets")),
        "lifecycle": ("lifecycle states", *least("lifecycle_states", 3, " states")), "reasoning_chains": ("reasoning chains", *least("chains", 5, " chains")), "biological_state": ("states with snapshots", *least("states", 5, " states")), "scan_results": ("results with versions", *least("results", 20, " results")),
        "audit_log": ("audit events", c("events") > 20, s("events", " events, ", "event_types", " types")), "tissues": ("tissues", *least("tissues", 5, " tissues")), "cell_types": ("cell types", *least("cell_types", 3, " cell types")), "ontology_dag": ("term hierarchy", *least("hierarchy", 10, " edges")),
        "drug_directional": ("signed drug edges", *least("signed_drugs", 20, " edges")), "off_target": ("off-target edges", *least("off_targets", 10, " edges")), "compound_fingerprints": ("fingerprints", *least("compounds", 20, " compounds")), "gene_protein_link": ("genes linked to proteins", *least("encodes", 20, " edges")),
    }
    return [(k, *v) for k, v in out.items()]


def capabilities(nodes: DataFrame, edges: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """(capability, status, description, detail): conditional aggregates over nodes and over edges (with labels), these in one pass."""
    checks = Checks(nodes, edges, names)
    a, b, kinds = checks.node_aggregates(), checks.edge_aggregates(), checks.edge_kinds()
    history = edges.where((F.col("_type") == checks.name("HAS_VERSION")) & (F.col("from_label") == checks.name("Hypothesis"))).groupBy("_from").agg(F.count("*").alias("v")).agg(F.count_if(F.col("v") >= 2).alias("with_history"), F.avg(F.when(F.col("v") >= 2, F.col("v"))).alias("avg_versions"))
    figures = {*a, *b, *checks.node_kinds(), *kinds, "with_history"}
    # edges are read once: their figures are kept for each combination of the kinds, and both sums and different kinds follow from these rows
    cells = edges.groupBy(*[v.alias(f"_{k}") for k, v in kinds.items()]).agg(*[v.alias(k) for k, v in b.items()])
    ensure_checkpoint_dir(edges.sparkSession)
    cells = cells.checkpoint()
    over = {"year_lo": F.min, "year_hi": F.max}
    whole = cells.agg(*[over[k](k).alias(k) if k in over else F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in b])
    one = nodes.agg(*[v.alias(k) for k, v in a.items()])
    for row_ in (whole, different(nodes, checks.node_kinds()), different(cells, {k: F.col(f"_{k}") for k in kinds}), history):  # single rows
        one = one.crossJoin(row_)
    row = lambda k, st, d, x: F.struct(F.lit(k).alias("capability"), st.alias("status"), F.lit(d).alias("description"), x.alias("detail"))
    found = [row(k, F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL"), d, F.coalesce(x, F.lit("no rows"))) for k, d, ok, x in rules(figures)]
    found += [row(k, F.lit("UNSUPPORTED"), k.replace("_", " "), F.lit(why)) for k, why in UNSUPPORTED.items()]
    return one.select(F.explode(F.array(*found)).alias("r")).select("r.*")


# fixed values: what each primitive needs
PRIMITIVES = {
    "N01": ("topology",), "N02": ("topology",), "N03": ("topology",), "N04": ("topology",), "N05": ("topology",), "N06": ("edge_scores",),
    "N07": ("node_metadata",), "N08": ("node_metadata",), "N09": ("topology",), "N10": ("cohorts", "topology"),
    "E01": ("edge_provenance", "edge_recency"), "E02": ("edge_scores",), "E03": ("edge_scores",), "E04": ("edge_scores",), "E05": ("edge_conflict",),
    "E06": ("edge_conflict",), "E07": ("edge_conflict",), "E08": ("edge_scores",), "E09": ("edge_scores",), "E10": ("embeddings",),
    "E11": ("edge_provenance", "datasets"), "E12": ("topology",), "E13": ("datasets",), "E14": ("edge_scores",),
    "E15": ("edge_provenance", "assertions"), "E16": ("edge_modality",), "E17": ("edge_modality",), "E18": ("edge_direction",),
    "E19": ("edge_recency",), "E20": ("edge_scores",), "E21": ("evidence_stage",), "E22": ("evidence_batch",),
    "T01": ("topology",), "T02": ("topology",), "T03": ("topology",), "T04": ("topology",), "T05": ("topology",), "T06": ("topology",),
    "T07": ("topology", "edge_direction"), "T08": ("topology",), "T09": ("hypothesis_subgraph",), "T10": ("topology",), "T11": ("topology",),
    "T12": ("topology", "edge_direction"), "T13": ("topology",), "T14": ("topology",), "T15": ("orthologs",), "T16": ("biological_state",),
    "T17": ("datasets",), "T18": ("biological_state",), "T19": ("node_metadata",), "T20": ("topology",), "T21": ("topology",),
    "R01": ("embeddings",), "R02": ("embeddings",), "R03": ("embeddings",), "R04": ("embeddings",), "R05": ("embeddings",),
    "R06": ("confidence_components",), "R07": ("topology", "edge_scores"), "R08": ("version_history", "mc_trajectory"), "R09": ("topology",),
    "R10": ("topology", "edge_scores"), "R11": ("embeddings",), "R12": ("topology",), "R13": ("edge_scores",), "R14": ("embeddings",),
    "R15": ("topology", "edge_scores"), "R16": ("embeddings",), "R17": ("topology",), "R18": ("topology",), "R19": ("variant_stats", "qtl"),
    "R20": ("cohorts", "variant_stats"), "R21": ("qtl",), "R22": ("orthologs",), "R23": ("edge_scores",),
    "S01": ("provenance_fields",), "S02": ("provenance_fields",), "S03": ("version_history",), "S04": ("edge_scores",), "S05": ("topology",),
    "S06": ("confidence_components",), "S07": ("biological_state",), "S08": ("confidence_components",), "S09": ("version_history",),
    "S10": ("scan_results",), "S11": ("mc_trajectory",), "S12": ("embeddings",), "S13": ("audit_log",), "S14": ("hypotheses",),
    "S15": ("hypotheses",), "S16": ("assertions",), "S17": ("assertions",), "S18": ("assertions",), "S19": ("hypotheses",), "S20": ("hypotheses",),
    "S20H": ("topology",), "S21": ("biological_state",), "S22": ("hypotheses",),
    "I01": ("datasets",), "I02": ("assertions",), "I03": ("node_metadata",), "I04": ("assertions",), "I05": ("assertions",),
    "I06": ("edge_conflict",), "I07": ("datasets",), "I08": ("assertions",), "I09": ("topology",), "I10": ("edge_modality",),
    "G01": ("variant_stats", "variant_locus"), "G02": ("variant_stats", "cohorts"), "G03": ("qtl",), "G04": ("variant_stats",),
    "G05": ("cohorts", "variant_stats"),
    "H01": ("node_metadata",), "H02": ("version_history", "mc_trajectory"), "H03": ("assertions",), "H04": ("topology",), "H05": ("hypotheses",),
    "H06": ("scan_results",),
    "TEMP_01": ("version_history",), "TEMP_02": ("edge_recency",), "TEMP_03": ("embeddings",),
    "SEM_01": ("embeddings",), "SEM_02": ("embeddings",), "SEM_03": ("edge_conflict",), "SEM_04": ("hypotheses",), "SEM_05": ("embeddings",),
    "SEM_06": ("hypotheses",), "SEM_07": ("edge_scores",), "SEM_08": ("embeddings",), "SEM_09": ("edge_scores",),
    "SEM_10": ("topology", "edge_direction"),
    "PRIM_SEM_07": ("edge_scores",), "PRIM_SEM_08": ("embeddings",), "PRIM_SEM_09": ("edge_scores",), "PRIM_SEM_10": ("topology", "edge_direction"),
    "CLIN_01": ("ontology_dag",), "CLIN_02": ("clinical_evidence",), "CLIN_03": ("off_target",), "CLIN_04": ("clinical_evidence", "orthologs"),
    "SIM_01": ("topology",), "SIM_02": ("drug_directional",), "SIM_03": ("compound_fingerprints",), "SIM_04": ("topology",), "SIM_05": ("topology",),
    "SIM_06": ("embeddings",), "SIM_07": ("embeddings",), "SIM_08": ("topology",),
    "READ": ("scan_results",),
}
# fixed values: families whose primitives, numbered from 1, all need the same
FAMILIES = [
    ("V", 16, ("embeddings",)),
    ("P", 16, ()),
    ("EDIT_", 4, ("agriculture_data",)),
    ("BREED_", 6, ("agriculture_data",)),
    ("EPI_", 4, ("agriculture_data",)),
    ("MICRO_", 4, ("agriculture_data",)),
    ("ONC_", 6, ("topology", "cell_types")),
    ("IMM_", 6, ("topology", "cell_types")),
    ("NEURO_", 5, ("topology", "tissues")),
    ("CARDIO_", 4, ("topology", "tissues")),
    ("GENE_", 5, ("topology", "clinical_evidence")),
    ("RARE_", 4, ("variant_stats", "cohorts")),
    ("INF_", 4, ("topology", "orthologs")),
    ("AGE_", 4, ("topology", "tissues")),
]


def primitive_table() -> dict[str, tuple[str, ...]]:
    """Capabilities that each primitive needs."""
    return PRIMITIVES | {f"{prefix}{i:02d}": v for prefix, last, v in FAMILIES for i in range(1, last + 1)}


def primitive_capabilities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, list(v)) for k, v in primitive_table().items()], "primitive string, capabilities array<string>")


def needs(primitives: DataFrame, table: DataFrame) -> DataFrame:
    """Adds capabilities to rows with `primitive`: without its prefix, as it is, else the graph itself."""
    rows = primitives.withColumn("_bare", F.regexp_replace("primitive", "^PRIM_", ""))
    rows = rows.join(table.select(F.col("primitive").alias("_bare"), F.col("capabilities").alias("_a")), "_bare", "left").join(table.select("primitive", F.col("capabilities").alias("_b")), "primitive", "left")
    return rows.withColumn("capabilities", F.coalesce("_a", "_b", F.array(F.lit("topology")))).drop("_bare", "_a", "_b")


def verdicts(scans: DataFrame, table: DataFrame, status: DataFrame) -> DataFrame:
    """(scan_id, family, verdict, blockers): scans(scan_id, family, primitives). A scan without needs needs topology and edge scores."""
    kept = scans.where(~F.col("scan_id").startswith("AG-"))
    each = needs(kept.select("scan_id", F.explode_outer("primitives").alias("primitive")), table).select("scan_id", "primitive", F.explode_outer("capabilities").alias("capability"))
    each = each.where("primitive is not null and capability is not null").select("scan_id", "capability").distinct()
    default = kept.select("scan_id").join(each.select("scan_id").distinct(), "scan_id", "left_anti").select("scan_id", F.explode(F.array(F.lit("topology"), F.lit("edge_scores"))).alias("capability"))
    judged = each.unionByName(default).join(status.select("capability", "status"), "capability", "left").withColumn("status", F.coalesce("status", F.lit("ERROR")))
    bad = F.array_sort(F.collect_set(F.when(F.col("status") != "PASS", F.concat_ws(":", "capability", "status"))))
    found = judged.groupBy("scan_id").agg(F.bool_or(F.col("status") == "UNSUPPORTED").alias("_u"), F.bool_or(F.col("status").isin("FAIL", "ERROR")).alias("_f"), bad.alias("blockers"))
    return kept.select("scan_id", "family").join(found, "scan_id").select("scan_id", "family", F.when(F.col("_u"), "UNSUPPORTED").when(F.col("_f"), "BLOCKED").otherwise("READY").alias("verdict"), "blockers")


def verdict_summary(found: DataFrame) -> DataFrame:
    total = F.sum("n").over(W.partitionBy(F.lit(1)))  # of three rows at most
    return found.groupBy("verdict").agg(F.count("*").alias("n")).select("verdict", "n", F.round(100.0 * F.col("n") / F.greatest(total, F.lit(1)), 1).alias("pct"))


def verdicts_by_family(found: DataFrame) -> DataFrame:
    return found.groupBy("family").pivot("verdict", ["READY", "BLOCKED", "UNSUPPORTED"]).count().na.fill(0)
