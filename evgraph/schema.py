"""Contracts, specs and lookup tables of the property graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: evidence formulas' lookup tables
SOURCE_AUTHORITY = {
    "curated_ontology": 1.00, "peer_reviewed": 0.85, "clinical_registry": 0.85, "user_uploaded": 0.75,
    "preprint": 0.60, "user_hypothesis": 0.50, "llm_inference": 0.30, "chat": 0.30,
}
EVIDENCE_STRENGTH = {
    "experimental_validation": 1.00, "replication": 0.90, "high_throughput": 0.75, "curated_db": 0.70,
    "inferred": 0.50, "text_mined": 0.40, "speculative": 0.25, "llm_inferred": 0.20,
}
DOMAIN_MULTIPLIER = {
    "oncology": 1.4, "immunology": 1.1, "neurodegeneration": 1.0, "cardiometabolic": 1.2, "gene_therapy": 0.8,
    "rare_disease": 0.35, "infectious_disease": 1.1, "aging": 0.7, "agriculture": 0.6, "general": 1.0,
}
ACTION_DIRECTION = {
    "INHIBITOR": -1, "ANTAGONIST": -1, "BLOCKER": -1, "NEGATIVE MODULATOR": -1, "NEGATIVE ALLOSTERIC MODULATOR": -1,
    "RNAI INHIBITOR": -1, "DEGRADER": -1, "ANTISENSE INHIBITOR": -1, "DISRUPTING AGENT": -1,
    "AGONIST": 1, "ACTIVATOR": 1, "POSITIVE MODULATOR": 1, "OPENER": 1, "POSITIVE ALLOSTERIC MODULATOR": 1,
    "PARTIAL AGONIST": 1, "STABILISER": 1,
}
STAGE_PHASE = {"PHASE_1": 1, "PHASE_2": 2, "PHASE_3": 3, "PHASE_4": 4, "APPROVED": 4, "PRECLINICAL": 0}
CHANNEL_TYPE = {"genetic_association": "GENETICALLY_LINKS_TO", "somatic_mutation": "CAUSES", "literature": "BIOMARKER_FOR"}
HIGH_AUTHORITY_JOURNALS = [
    "nature", "science", "cell", "the new england journal of medicine", "lancet", "nature medicine", "nature genetics",
    "cancer cell", "immunity", "neuron", "the lancet", "jama", "nature biotechnology",
]
SYNTHESIS_METHODS = ["degree_preserving_expansion", "statistical_distribution", "governance_simulation", "ontology_derived", "template_instantiation", "manual_fixture"]
TIERS = (("Tier 1", 0.85), ("Tier 2", 0.60), ("Tier 3", 0.40))
INGESTION_THRESHOLD = 0.10
# fixed values: fields of the node and edge contracts that must be present
NODE_REQUIRED = [
    "uid", "canonical_id", "entity_type", "synonyms", "ontology_refs", "source_ids", "source", "source_priority", "is_synthetic",
    "created_at", "updated_at", "ingested_at", "valid_from", "Dv_created", "Tv_created", "schema_version", "record_hash", "layer",
]
EDGE_REQUIRED = [
    "edge_id", "_from", "_to", "_type", "SA", "ES_edge", "edge_aggregate_score", "direction", "evidence_count", "edge_class", "source_type",
    "dataset_ids", "source", "source_priority", "is_synthetic", "created_at", "updated_at", "ingested_at", "valid_from", "schema_version",
    "record_hash", "layer",
]
TEMPORAL_FIELDS = [
    "created_at", "updated_at", "ingested_at", "valid_from", "valid_to", "source_retrieved_at", "promotion_ts",
    "executed_at", "entered_at", "exited_at", "timestamp",
]
#: Nominal degree of an endpoint pair by its labels; the first rule that fits holds.
DEGREE_RULES = [
    (("Gene", "Gene"), 4.5), (("Protein", "Protein"), 4.0), (("Pathway",), 3.0), (("Tissue",), 6.0), (("Publication", "Evidence"), 2.0),
    (("Variant",), 1.6), (("Disease",), 6.0 / 4), (("Drug", "Compound"), 2.5), (("Hypothesis",), 3.0), (("Species",), 0.6),
]
DEFAULT_DEGREE = 1.2

# fixed values: retired relations (conflict, type, from, to, successor, whether the row runs opposite to it, kind of retirement)
RETIRED = [
    ("C-01", "CAUSES", "BiologicalProcess", "Disease", "DRIVES_DISEASE_PATHOLOGY", False, "synonym_merge"),
    ("C-01", "DRIVES_PATHOLOGY", "BiologicalProcess", "Disease", "DRIVES_DISEASE_PATHOLOGY", False, "synonym_merge"),
    ("C-02", "PRECEDES", "BiologicalProcess", "BiologicalProcess", "TEMPORALLY_PRECEDES", False, "synonym_merge"),
    ("C-03", "RESULTS_IN", "BiologicalProcess", "Phenotype", "PRODUCES_CLINICAL_PHENOTYPE", False, "synonym_merge"),
    ("C-03", "PRODUCES_OUTCOME", "BiologicalProcess", "Phenotype", "PRODUCES_CLINICAL_PHENOTYPE", False, "synonym_merge"),
    ("C-04", "EVOLUTIONARILY_CONSERVED_IN", "BiologicalProcess", "Species", "CONSERVED_IN", False, "synonym_merge"),
    ("C-05", "SERVES_AS_BIOMARKER_FOR", "BiologicalProcess", "Disease", "BIOMARKER_FOR", False, "synonym_merge"),
    ("C-06", "PART_OF", "BiologicalProcess", "Pathway", "CONSTITUTES_PATHWAY", False, "synonym_merge"),
    ("C-07", "ACTIVATED_BY", "BiologicalProcess", "Drug", "PHARMACOLOGICALLY_ACTIVATES", True, "redirect"),
    ("C-07", "SUPPRESSED_BY", "BiologicalProcess", "Drug", "PHARMACOLOGICALLY_INHIBITS", True, "redirect"),
    ("C-08", "INVOLVES", "BiologicalProcess", "Variant", "mQTL_MODULATES", True, "inverse_merge"),
    ("C-09", "OCCURS_IN", "BiologicalProcess", "Tissue", "OPERATES_WITHIN_CONTEXT", False, "inverse_merge"),
    ("C-09", "CONTEXTUALIZES", "Tissue", "BiologicalProcess", "OPERATES_WITHIN_CONTEXT", True, "inverse_merge"),
    ("C-09", "OCCURS_IN", "ProteinComplex", "Tissue", "OPERATES_WITHIN_CONTEXT", False, "inverse_merge"),
    ("C-10", "SUPPORTED_BY", "BiologicalProcess", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "PROCESS_EVIDENCED_BY", "BiologicalProcess", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "SUPPORTED_BY", "Gene", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "SUPPORTED_BY", "Tissue", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "SUPPORTED_BY", "ProteinComplex", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "PHENOTYPICALLY_SUPPORTED_BY", "Phenotype", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "DISEASE_EVIDENCED_BY", "Disease", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "SUPPORTED_BY_PROVENANCE", "Hypothesis", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-10", "DRUG_EVIDENCED_BY", "Drug", "Publication", "EVIDENCED_BY", False, "collapse"),
    ("C-12", "STANDARDIZES_DISEASE", "Disease", "OntologyTerm", "STANDARDIZED_BY_ONTOLOGY", False, "synonym_merge"),
    ("C-13", "REGULATED_BY_QTL", "Gene", "Variant", "eQTL_MODULATES", True, "inverse_merge"),
    ("C-14", "EXPRESSES", "Tissue", "Gene", "EXPRESSED_IN", True, "inverse_merge"),
    ("C-15", "EXHIBITS_PATHOLOGY_OF", "Tissue", "Disease", "LOCALIZES_PATHOLOGY_IN", True, "inverse_merge"),
    ("C-16", "ACCUMULATES", "Tissue", "Drug", "DISTRIBUTED_IN_CONTEXT", True, "inverse_merge"),
    ("C-17", "CAUSALLY_DRIVES", "Variant", "Disease", "MR_VALIDATES_RISK_FOR", False, "synonym_merge"),
    ("C-18", "AMELIORATES", "Drug", "Phenotype", "AMELIORATES_TRAIT", False, "synonym_merge"),
    ("C-19", "TREATS_INDICATION", "Drug", "Disease", "CLINICALLY_TREATS", False, "synonym_merge"),
]
RETIREMENT_SCHEMA = "conflict string, type string, from_label string, to_label string, superseded_by string, reverse boolean, kind string"


def retirements(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Retired triples and their successors; `rows` replace the built-in ones."""
    return spark.createDataFrame(rows or RETIRED, RETIREMENT_SCHEMA)
