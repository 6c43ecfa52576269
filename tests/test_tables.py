import pytest
from pyspark.sql import functions as F

from evgraph.operators import contract, expand, graph, upsert
from evgraph.plans import report
from evgraph.sources import seeds, tables


def test_jsonl_and_times(spark, tmp_path):
    path = tmp_path / "n.jsonl"
    path.write_text('{"uid": "A:1", "created_at": "2024-01-02T03:04:05Z", "extra": 1}\n\n   \n{"uid": "A:2", "created_at": null}\n')
    rows = tables.cast_times(tables.read_jsonl(spark, str(path), "uid string, created_at string"))
    got = {r["uid"]: r["created_at"] for r in rows.collect()}
    assert len(got) == 2 and got["A:2"] is None and got["A:1"].year == 2024


def test_replace(spark, tmp_path):
    path, n = tables.replace(spark.range(5).withColumn("k", F.col("id") % 2), str(tmp_path), "k")
    assert n == 5 and spark.read.parquet(path).count() == 5
    other, _ = tables.replace(spark.range(3).withColumn("k", F.col("id") % 2), str(tmp_path), "k")
    assert other != path and spark.read.parquet(path).count() == 5


def test_upsert_and_patch(spark):
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "uid string, v int, w string")
    new = spark.createDataFrame([("a", 5, None, 1), ("a", 6, "z", 2), ("c", 7, "q", 1)], "uid string, v int, w string, seq long")
    assert {tuple(r) for r in upsert.upsert(now, new, ["uid"]).collect()} == {("a", 6, "z"), ("b", 2, "y"), ("c", 7, "q")}
    sparse = spark.createDataFrame([("a", None, "n", ["v"]), ("c", 9, None, ["v", "w"])], "uid string, v int, w string, present array<string>")
    assert {tuple(r) for r in upsert.patch(now, sparse, ["uid"]).collect()} == {("a", None, "x"), ("b", 2, "y"), ("c", 9, None)}


def test_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "uid string")
    e = spark.createDataFrame([("a", "T", "b", 2), ("a", "T", "b", 1), ("a", "T", "a", 3), ("a", "T", None, 4), ("a", "T", "zz", 5)], "_from string, _type string, _to string, seq long")
    assert {tuple(r) for r in upsert.dedup_edges(e, "seq").collect()} == {("a", "T", "b", 1), ("a", "T", "zz", 5)}
    assert [tuple(r) for r in upsert.dangling_edges(e.where("_to is not null"), nodes).collect()] == [("a", "T", "zz", "_to")]


SPECS = [("Gene", "core", False, ["symbol"]), ("Dataset", "evidence", True, [])]


def stamped(spark, rows):
    specs = spark.createDataFrame(SPECS, "label string, layer string, species_agnostic boolean, required array<string>")
    raw = spark.createDataFrame(rows, "entity_type string, canonical_id string, symbol string, species long")
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    prov = contract.provenance(F.lit("s"), F.lit(1), F.lit(False), F.lit(None).cast("string"))
    return raw, contract.stamp_nodes(raw, F.col("entity_type"), now, prov, ["symbol"]), specs


def test_contract(spark):
    rows = [("Gene", "1", "S", 9606), ("Gene", "2", None, 9606), ("Gene", "3", "S", None), ("Alien", "4", "S", 1), ("Gene", " ", "S", 1)]
    raw, nodes, specs = stamped(spark, rows)
    problems = {tuple(r) for r in contract.node_violations(nodes, specs).collect()}
    assert problems == {("Gene:2", "missing type field symbol"), ("Gene:3", "missing species"), ("Alien:4", "unknown label Alien")}
    broken = nodes.where("uid = 'Gene:1'").withColumns({"uid": F.lit("x"), "updated_at": F.col("created_at") - F.expr("interval 1 day"), "is_synthetic": F.lit(True), "layer": F.lit("z")})
    assert {r["problem"] for r in contract.node_violations(broken, specs).collect()} == {"uid mismatch", "updated before created", "synthetic without method", "layer mismatch"}
    good, bad = contract.split_nodes(raw, specs)
    assert [r["canonical_id"] for r in good.collect()] == ["1"] and bad.count() == 4
    with pytest.raises(ValueError, match="contract"):
        contract.gate(upsert.duplicate_ids(nodes), contract.node_violations(nodes, specs))
    assert nodes.first()["synonyms"] == []
    # a field without a column is missing everywhere
    lost = nodes.where("uid = 'Gene:1'").drop("record_hash", "symbol", "species")
    assert {r["problem"] for r in contract.node_violations(lost, specs).collect()} == {"missing record_hash", "missing species", "missing type field symbol"}
    assert contract.split_nodes(raw.drop("symbol"), specs)[1].where("array_contains(reasons, 'missing type field symbol')").count() == 4


def test_hash_and_edge_id(spark):
    _, nodes, _ = stamped(spark, [("Gene", "1", "S", 1)])
    later = nodes.withColumn("updated_at", F.current_timestamp()).withColumn("record_hash", contract.record_hash("symbol"))
    assert later.first()["record_hash"] == nodes.first()["record_hash"]
    ids = spark.range(1).select(contract.edge_id(F.lit("a"), F.lit("T"), F.lit("b")).alias("x"), contract.edge_id(F.lit("b"), F.lit("T"), F.lit("a")).alias("y")).first()
    assert ids["x"] != ids["y"] and len(ids["x"]) == 32
    e = spark.createDataFrame([("a", "T", "a", None), ("a", "T", "b", 1.0)], "_from string, _type string, _to string, SA double")
    ok, bad = contract.split_edges(e, ["_from", "_to", "_type", "SA"])
    assert ok.count() == 1 and bad.first()["reasons"] == ["self-loop", "missing SA"]


def test_readiness(spark):
    status = spark.createDataFrame([("topology", "PASS"), ("edge_scores", "FAIL"), ("embeddings", "UNSUPPORTED")], "capability string, status string")
    scans = spark.createDataFrame([("a", "f", ["PRIM_N01"]), ("b", "f", []), ("c", "f", ["V02", "E02"]), ("d", "f", ["XX"]), ("AG-1", "g", ["N01"]), ("e", "g", ["E13"])], "scan_id string, family string, primitives array<string>")
    got = {r["scan_id"]: r["verdict"] for r in report.verdicts(scans, report.primitive_capabilities(spark), status).collect()}
    assert got == {"a": "READY", "b": "BLOCKED", "c": "UNSUPPORTED", "d": "READY", "e": "BLOCKED"}


def test_capabilities_without_edges(spark):
    _, nodes, _ = stamped(spark, [("Gene", str(i), "S", 1) for i in range(200)])
    edges = spark.createDataFrame([], "_from string, _type string, _to string, from_label string, to_label string")
    got = {r["capability"]: (r["status"], r["detail"]) for r in report.capabilities(nodes, edges).collect()}
    assert len(got) == 41 and got["topology"] == ("FAIL", "no rows") and got["orthologs"] == ("FAIL", "no rows")
    assert got["node_metadata"][0] == "PASS" and got["embeddings"][0] == "UNSUPPORTED"


def everything(spark, share=1.0):
    """Nodes and edges with which every capability that a graph can have is there, or a share of these rows."""
    fields = {
        "Dataset": (10, {}), "Cohort": (4, {"cohort_state": "s{2}"}), "Assertion": (60, {"promotion_decision": "d{2}"}), "Evidence": (60, {"modality": "m{4}", "disease_stage": "t{2}", "batch_id": "b", "platform": "p", "lab_id": "l", "is_clinical": "true"}),
        "Publication": (60, {"source_type": "journal"}), "Variant": (100, {"chromosome": "1", "base_position": "5", "p_raw": "0.1", "effect_weight": "0.2"}), "Gene": (30, {}), "Protein": (30, {}), "Species": (3, {}),
        "Hypothesis": (12, {"biological_domain": "x", "decision_context": "y"}), "HypothesisVersion": (30, {"delta_MC": "0.01"}), "ConfidenceScore": (5, {f"component_{c}": "0.5" for c in ("C", "dS", "R", "P", "K")}),
        "LifecycleState": (3, {"name": "n{3}"}), "ReasoningChain": (5, {"path_traceability": "1"}), "BiologicalState": (5, {"snapshot_hash": "h"}), "ScanResult": (20, {"Dv": "1", "Tv": "1", "Hv": "1", "snapshot_hash": "h"}),
        "AuditEvent": (25, {"event_type": "e{2}"}), "Tissue": (5, {}), "CellType": (3, {}), "Compound": (20, {"morgan_fp": "1"}), "OntologyTerm": (20, {}), "Drug": (20, {}),
    }
    names = sorted({k for _, f in fields.values() for k in f})
    base = {"synonyms": "", "ontology_refs": "", "created_at": "t", "source": "s", "is_synthetic": "false", "valid_from": "t", "updated_at": "t"}
    rows = []
    for label, (n, own) in fields.items():
        for i in range(int(n * share)):
            value = lambda v, i=i: v.split("{")[0] + str(i % int(v.split("{")[1][:-1])) if "{" in v else v
            rows.append((f"{label}:{i}", str(i), label, *base.values(), *[value(own[k]) if k in own else None for k in names]))
    nodes = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in ["uid", "canonical_id", "entity_type", *base, *names]))
    pairs = [
        ("MAPS_TO_LOCUS", "Variant", "Gene", 10), ("eQTL_MODULATES", "Variant", "Gene", 60), ("ORTHOLOG_OF", "Gene", "Gene", 12), ("HYPOTHESIS_INCLUDES_NODE", "Hypothesis", "Gene", 20), ("HAS_VERSION", "Hypothesis", "HypothesisVersion", 24),
        ("ONTOLOGICALLY_INCLUDES", "OntologyTerm", "OntologyTerm", 10), ("PHARMACOLOGICALLY_INHIBITS", "Drug", "Gene", 20), ("EXERTS_OFF_TARGET_EFFECT", "Drug", "Gene", 10), ("ENCODES", "Gene", "Protein", 20), ("LINKS", "Gene", "Gene", 600),
    ]
    made = [(f"{a}:{i % 12}", t, f"{b}:{i}", a, b, 0.5, 0.5, 0.5, f"Tier {i % 2 + 1}", 1, 1, 1 if i % 2 else -1, "d", "s", 1990 + i % 10, "v1", f"m{i % 3}") for t, a, b, n in pairs for i in range(int(n * share))]
    return nodes, spark.createDataFrame(made, "_from string, _type string, _to string, from_label string, to_label string, SA double, ES_edge double, edge_aggregate_score double, edge_quality_tier string, pos_count long, neg_count long, direction int, dataset_ids string, source_type string, publication_year int, formula_version string, modality string")


def test_every_capability_can_pass_and_fail(spark):
    nodes, edges = everything(spark)
    got = {r["capability"]: (r["status"], r["detail"]) for r in report.capabilities(nodes, edges).collect()}
    assert len(got) == 41 and {k for k, (s, _) in got.items() if s != "PASS"} == {"agriculture_data", "embeddings"}, {k: v for k, v in got.items() if v[0] != "PASS"}
    details = {
        "edge_modality": "3 modalities over 786 edges", "edge_recency": "10 distinct years (1990-1999)", "evidence_modality": "4 modalities / 60 records", "evidence_stage": "2 stages / 60 records", "qtl": "60 edges, 1 kinds",
        "hypotheses": "12 hypotheses, 1 domains", "version_history": "12 hypotheses with history (avg 2.0 versions)", "audit_log": "25 events, 2 types",
    }
    assert {k: got[k][1] for k in details} == details
    few = {r["capability"]: r["status"] for r in report.capabilities(*everything(spark, 0.1)).collect()}
    kept = {"node_metadata", "provenance_fields"}  # no node lacks a field, however few there are
    spread = {"edge_tiers", "edge_modality", "edge_recency", "evidence_modality", "evidence_stage", "cohorts"}  # different values, not rows
    assert all(few[k] == "FAIL" for k in few if k not in kept | spread | {"agriculture_data", "embeddings"})
    plain = nodes.withColumns({c: F.lit("same") for c in ("modality", "disease_stage", "cohort_state", "promotion_decision")}).withColumn("source", F.lit(None).cast("string")).drop("synonyms")
    same = {r["capability"]: r["status"] for r in report.capabilities(plain, edges.withColumns({"edge_quality_tier": F.lit("Tier 1"), "modality": F.lit("m"), "publication_year": F.lit(2000)})).collect()}
    assert all(same[k] == "FAIL" for k in kept | spread | {"assertions"})


def test_gap_report(spark):
    """Composition of pairs, paths, reach, components and verdict on a graph whose figures are known."""
    rows = [("a", "T", "b"), ("c", "T", "d"), ("a", "E", "1"), ("1", "E", "b"), ("c", "A", "hub"), ("hub", "B", "d"), ("z1", "T", "z2")]
    edges = spark.createDataFrame(rows, "_from string, _type string, _to string")
    got = graph.gap_report(edges, "T", "A", "B", 10).first().asDict()
    assert got["cognate_edges"] == 3 and (got["pairs"], got["with_path"], got["mean_length"]) == (3, 2, 2.0) and got["pct_with_path"] == 66.7
    assert (got["sources"], got["reaching"], got["mean_reach"], got["reach_pct"]) == (1, 1, 1.0, 10.0)
    assert (got["components_with"], got["components_without"], got["verdict"]) == (3, 2, "NOT CONFIRMED")
    two = graph.gap_report(edges.where("_from <> 'z1'"), "T", "A", "B", 10).first()
    assert two["pct_with_path"] == 100.0 and two["verdict"] == "SEVERE" and (two["components_with"], two["components_without"]) == (2, 2)


def test_seeds_of_bad_records(spark):
    raw = spark.createDataFrame([("t", "u1", None, '{"data": {"target": {"id": "E1", "associatedDiseases": {"rows": [{"score": 0.5, "disease": {"id": "MONDO_1_2"}, "datatypeScores": [{"id": "x", "score": 1.0}, {"id": "x", "score": 2.0}]}, {"disease": null}]}}}}'), ("t", "u2", None, "{}"), ("t", "u3", None, "not json"), ("t", "u4", None, None)], "source string, url string, retrieved_at timestamp, data string")
    got = seeds.target_diseases(raw).collect()
    assert len(got) == 1 and got[0]["disease_id"] == "MONDO:1_2" and got[0]["datatype_scores"] == {"x": 2.0} and got[0]["therapeutic_areas"] == []
    for f in (seeds.target_drugs, seeds.target_homologues, seeds.interactions, seeds.variants, seeds.terms, seeds.publications, seeds.parents):
        assert f(raw).count() == 0


def test_expansion(spark):
    nodes = spark.createDataFrame([("A", f"A:{i:03}") for i in range(50)] + [("B", f"B:{i:03}") for i in range(40)], "entity_type string, uid string")
    specs = spark.createDataFrame([("R", "A", "B"), ("S", "A", "A"), ("T", "A", "Nobody")], "type string, from_label string, to_label string")
    none = spark.createDataFrame([("A:000", "R", "B:000", "A", "B")], "_from string, _type string, _to string, from_label string, to_label string")
    needs = expand.allocate(specs, nodes, none, 1000, [])
    assert {(r["type"], r["planned"], r["need"]) for r in needs.collect()} == {("R", 60, 59), ("S", 60, 60)}
    made = expand.expand(needs, nodes, none)
    rows = [tuple(r) for r in made.collect()]
    assert len({r[:3] for r in rows}) == len(rows) and all(r[1] != r[2] for r in rows) and ("R", "A:000", "B:000") not in {r[:3] for r in rows}
    assert sum(r[0] == "R" for r in rows) == 59 and sorted(rows) == sorted(tuple(r) for r in expand.expand(needs, nodes, none).collect())
    head = sum(r[2] < "B:020" for r in rows if r[0] == "R")
    assert head > 59 / 2


def test_each_response_is_parsed_once(spark):
    """Filters on parsed values aren't pushed below the parser with copies of it."""
    raw = spark.createDataFrame([("s", "u", None, '{"data": {"target": {"id": "E1", "homologues": [{"targetGeneSymbol": "g", "speciesId": "1"}]}}}')], "source string, url string, retrieved_at timestamp, data string")
    for parse in (seeds.target_diseases, seeds.target_drugs, seeds.target_homologues):
        assert parse(raw)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [x["target_symbol"] for x in seeds.target_homologues(raw).collect()] == ["g"] and not seeds.target_drugs(raw).count()
