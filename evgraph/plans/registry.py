"""Registered queries, each over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph import schema
from evgraph.functions import scoring
from evgraph.operators import centrality, contract, expand, graph, history, migrate, neighbours, paths, similarity, upsert
from evgraph.operators.components import ensure_checkpoint_dir
from evgraph.plans import adhoc, fixture_seeds, oracle as o, report
from evgraph.plans import fixture_graph as fx
from evgraph.sources import seeds, tables, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_edges(fx.purchases(spark, d), fx.CURRENT_YEAR)


def stamped_nodes(spark: SparkSession, d: str) -> DataFrame:
    now = F.to_timestamp(F.lit("2002-06-01 00:00:00"))
    prov = contract.provenance(F.lit("star"), F.lit(1), F.lit(False), F.lit(None).cast("string"))
    return contract.stamp_nodes(fx.nodes(spark, d), F.col("entity_type"), now, prov, ["name", "category", "amount"])


def stamped_edges(spark: SparkSession, d: str) -> DataFrame:
    now = F.to_timestamp(F.lit("2002-06-01 00:00:00"))
    synthetic = F.col("publication_year") < 1998
    prov = contract.provenance(F.lit("star"), F.lit(2), synthetic, F.when(synthetic, "statistical_distribution"))
    return contract.stamp_edges(scored(spark, d).withColumn("direction", F.when(F.col("effect_size") > 0.2, 1).when(F.col("effect_size") < -0.2, -1).otherwise(0)), now, prov, ["effect_size", "adj_p", "n"], layer="evidence")


def structure(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [fx.bulk(spark, d), fx.brand_chain(spark, d), fx.favourites(spark, d)])


# ---------------------------------------------------------------- scoring


@query(f"SELECT edge_quality_tier, concordance_flag, count(*) AS n FROM ({o.SCORED}) GROUP BY 1, 2")
def m1_edges_by_tier_and_flag(spark, d):
    return scored(spark, d).groupBy("edge_quality_tier", "concordance_flag").agg(F.count("*").alias("n"))


@query(f"SELECT * EXCLUDE (adj_p) FROM ({o.SCORED})")
def d15_score_edges(spark, d):
    return scored(spark, d).drop("adj_p")


DEFAULTS = [("BUYS_FROM", "Customer", "Supplier", 1), ("SUPPLIES", "Supplier", "Part", -1)]


def bundled(spark, d):
    """Scored edges with their whole bundle: the priority stands for the modality, and a direction is only known where the effect is clear."""
    e, relations = scored(spark, d), spark.createDataFrame(DEFAULTS, "type string, from_label string, to_label string, direction_default int")
    clear = F.when(F.col("effect_size") > 0.2, 1).when(F.col("effect_size") < -0.2, -1)
    return scoring.edge_bundle(e.withColumns({"direction": clear, "modality": F.col("domain"), "dataset_ids": F.when(F.col("n") >= 50, F.array("evidence_type"))}), relations)


@query(f"""SELECT _from, _type, _to, CASE WHEN effect_size > 0.2 THEN 1 WHEN effect_size < -0.2 THEN -1 ELSE 1 END AS direction, domain AS modality, NULL::BIGINT AS observed_families, CASE WHEN n >= 50 THEN [evidence_type] ELSE [] END AS dataset_ids,
[]::VARCHAR[] AS assertion_ids, 'v2.0' AS formula_version FROM ({o.SCORED})""")
def d15_edge_bundle(spark, d):
    return bundled(spark, d).select("_from", "_type", "_to", "direction", "modality", "observed_families", "dataset_ids", "assertion_ids", "formula_version")


@query(f"SELECT agg > 0.1 AS kept, count(*) AS n FROM (SELECT {o.SCORE} AS agg FROM ({o.BUYS})) GROUP BY 1")
def d14_ingestion_filter(spark, d):
    e = fx.purchases(spark, d).select(scoring.aggregate(F.col("effect_size"), F.col("adj_p"), F.col("n")).alias("agg"))
    return e.groupBy(scoring.passes_ingestion(F.col("agg")).alias("kept")).agg(F.count("*").alias("n"))


@query(f"SELECT _from, {o.r4('avg(CASE WHEN pos_count + neg_count >= 2 THEN 1.0 ELSE 0.0 END)')} AS replication FROM ({o.BUYS}) GROUP BY 1")
def d6_replication(spark, d):
    return fx.purchases(spark, d).groupBy("_from").agg(scoring.replication(F.col("pos_count") + F.col("neg_count")).alias("replication"))


@query(f"SELECT _from, _to, {o.r4('ln(1 + 5 * least(1, n / 50.0)) / ln(6)')} AS saturation, {o.r4('(pos_count - neg_count) / (pos_count + neg_count)::DOUBLE')} AS direction_score, {o.r4(f'1 - {o.SIGN}')} AS severity FROM ({o.BUYS})")
def d8_d11_direction_and_saturation(spark, d):
    e, c = fx.purchases(spark, d), F.col
    return e.select("_from", "_to", scoring.saturation(c("n"), F.lit(50)).alias("saturation"), scoring.direction_score(c("pos_count"), c("neg_count")).alias("direction_score"), scoring.conflict_severity(c("pos_count"), c("neg_count")).alias("severity"))


@query(f"""SELECT tier, count(*) AS n FROM (SELECT CASE WHEN s > 1 THEN 'Tier 4' WHEN s >= 0.85 THEN 'Tier 1' WHEN s >= 0.6 THEN 'Tier 2' WHEN s >= 0.4 THEN 'Tier 3' ELSE 'Tier 4' END AS tier
FROM (SELECT {o.r4('0.3 * SA + 0.25 * ES_edge + 0.35 * recency + 0.1 * replication_score')} AS s FROM ({o.SCORED}))) GROUP BY 1""")
def d12_consolidated_tiers(spark, d):
    s = scoring.consolidated(*[F.col(c) for c in ("SA", "ES_edge", "recency", "replication_score")])
    return scored(spark, d).select(scoring.tier(s).alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))


@query(f"""SELECT _from, _to, CASE WHEN ES_edge >= 0.8 AND SA >= 0.9 THEN 'AUTOMATIC' WHEN ES_edge < 0.55 THEN 'REJECTED' ELSE 'REVIEW' END AS decision,
{o.r4('least(1, abs(effect_size) / 2)')} AS strength FROM ({o.SCORED})""")
def d16_promotion(spark, d):
    p = scoring.promotion(F.col("ES_edge"), F.col("SA"), F.col("effect_size"))
    return scored(spark, d).select("_from", "_to", p["decision"].alias("decision"), p["strength"].alias("strength"))


@query(f"""SELECT _from, _to, {o.r4('0.25 * ES_edge + 0.25 * recency + 0.2 * replication_score + 0.15 * SA - 0.15 * conflict_score')} AS MC,
{o.r4('0.4 * conflict_score + 0.35 * (1 - replication_score) + 0.25 * SA')} AS MR FROM ({o.SCORED})""")
def d17_mechanism_scores(spark, d):
    c = F.col
    return scored(spark, d).select("_from", "_to", scoring.mechanism_confidence(c("ES_edge"), c("recency"), c("replication_score"), c("SA"), c("conflict_score")).alias("MC"), scoring.mechanism_risk(c("replication_score"), c("SA"), c("conflict_score")).alias("MR"))


# ---------------------------------------------------------------- history

CHANGES = f"""SELECT hypothesis_id, Hv, MC, {o.r4('d')} AS delta_MC, {o.r4('greatest(0, 1 - coalesce(avg(abs(d)) OVER (PARTITION BY hypothesis_id ORDER BY Hv ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 0) / 0.2)')} AS stability
FROM (SELECT *, MC - lag(MC) OVER (PARTITION BY hypothesis_id ORDER BY Hv) AS d FROM ({o.VERSIONS}))"""


@query(CHANGES)
def w1_w2_changes_and_stability(spark, d):
    return history.with_changes(fx.versions(spark, d))


@query(f"SELECT count(delta_MC) AS n, count(*) FILTER (abs(delta_MC) < 0.02) AS converged FROM ({CHANGES})")
def w3_convergence(spark, d):
    return history.convergence(history.with_changes(fx.versions(spark, d)))


@query(f"SELECT count(*) AS n, round(avg(vc), 4) AS avg_versions FROM (SELECT count(*) AS vc FROM ({o.VERSIONS}) GROUP BY hypothesis_id HAVING count(*) >= 2)")
def w4_history_depth(spark, d):
    return history.history_depth(fx.versions(spark, d))


@query(f"SELECT hypothesis_id, list(MC ORDER BY Hv) AS trajectory, last(MC ORDER BY Hv) AS current_MC FROM ({o.VERSIONS}) GROUP BY 1 ORDER BY 1 LIMIT 10")
def w5_trajectories(spark, d):
    return history.trajectories(fx.versions(spark, d))


# ---------------------------------------------------------------- tables and load


@query(f"SELECT entity_type, count(*) AS n, round(sum(amount), 2) AS amount FROM ({o.NODES}) GROUP BY 1")
def a1_a2_write_and_read_json(spark, d):
    path = tables.fresh_path(spark, "nodes")
    tables.write_graph(fx.nodes(spark, d).withColumn("label", F.col("entity_type")), path, "label", "json")
    back = tables.read_jsonl(spark, path, "uid string, canonical_id string, entity_type string, name string, category string, amount double")
    return back.groupBy("entity_type").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("SELECT c_custkey::VARCHAR AS canonical_id, '{\"segment\":\"' || c_mktsegment || '\",\"name\":\"' || c_name || '\"}' AS payload, NULL::VARCHAR AS notes FROM customer")
def a1_properties(spark, d):
    """Internal keys go, maps become JSON text; a field that no record has is null."""
    path = tables.fresh_path(spark, "graph")
    rows = fx.read(spark, d, "customer").select(F.lit("Customer").alias("_label"), F.col("c_custkey").cast("string").alias("canonical_id"), F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name")).alias("payload"))
    rows.write.json(path)
    return tables.read_graph(spark, path, "_label string, canonical_id string, payload map<string, string>, notes map<string, string>")


@query("SELECT 'Customer:' || c_custkey AS uid, coalesce(p, c_acctbal) AS amount FROM customer LEFT JOIN (SELECT o_custkey, last(o_totalprice ORDER BY o_orderkey) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def a3_upsert_nodes(spark, d):
    now = fx.nodes(spark, d).where("entity_type = 'Customer'").select("uid", "amount")
    new = fx.read(spark, d, "orders").select(fx.uid("Customer", "o_custkey").alias("uid"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("seq"))
    return upsert.upsert(now, new.join(now.select("uid"), "uid", "left_semi"), ["uid"])


@query("SELECT 'Supplier:' || s_suppkey AS uid, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 1.0 ELSE s_acctbal END AS amount FROM supplier")
def a3_patch_nodes(spark, d):
    now = fx.nodes(spark, d).where("entity_type = 'Supplier'").select("uid", "name", "amount")
    k = F.col("s_suppkey")
    present = F.array_compact(F.array(F.when(k % 3 == 0, "name"), F.when(k % 2 == 0, "amount")))
    new = fx.read(spark, d, "supplier").select(fx.uid("Supplier", "s_suppkey").alias("uid"), F.lit(None).cast("string").alias("name"), F.lit(1.0).alias("amount"), present.alias("present"))
    return upsert.patch(now, new, ["uid"])


@query("""SELECT 'Customer:' || c_custkey AS uid, coalesce(p, c_acctbal) AS amount, c_acctbal AS amount_before, 2::INTEGER AS versions FROM customer LEFT JOIN (SELECT o_custkey, last(o_totalprice ORDER BY o_orderkey) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def a3_a7_versioned_merge(spark, d):
    """The same upsert into a stored table: a second version, read beside the first one."""
    held = versions.VersionedTable(spark, tables.fresh_path(spark, "versioned"))
    now = fx.nodes(spark, d).where("entity_type = 'Customer'").select("uid", "amount")
    held.replace(now, ["uid"])
    new = fx.read(spark, d, "orders").select(fx.uid("Customer", "o_custkey").alias("uid"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("seq"))
    held.merge(new.join(now.select("uid"), "uid", "left_semi"), lambda rows, updates: upsert.upsert(rows, updates, ["uid"]))
    return held.read().join(held.read(0).withColumnRenamed("amount", "amount_before"), "uid").withColumn("versions", F.lit(len(held.versions())))


BROKEN = "(SELECT 'Customer:' || (CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END) AS _from, 'PLACES' AS _type, 'Order:' || (CASE WHEN o_orderkey % 15 = 0 THEN -o_orderkey ELSE o_orderkey END) AS _to, o_orderkey AS seq FROM orders)"


def broken_edges(spark, d):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    a, b = F.when(k % 10 == 0, -c).otherwise(c).cast("string"), F.when(k % 15 == 0, -k).otherwise(k).cast("string")
    return fx.read(spark, d, "orders").select(F.concat(F.lit("Customer:"), a).alias("_from"), F.lit("PLACES").alias("_type"), F.concat(F.lit("Order:"), b).alias("_to"), k.alias("seq"))


@query(f"SELECT _from, _type, _to FROM {BROKEN} WHERE _from NOT LIKE '%-%' AND _to NOT LIKE '%-%'")
def a4_upsert_edges(spark, d):
    new = broken_edges(spark, d)
    return upsert.upsert_edges(new.limit(0).drop("seq"), new, fx.nodes(spark, d))


@query(f"SELECT _from, _type, _to, '_from' AS missing FROM {BROKEN} WHERE _from LIKE '%-%' UNION ALL SELECT _from, _type, _to, '_to' FROM {BROKEN} WHERE _to LIKE '%-%'")
def a5_dangling_edges(spark, d):
    return upsert.dangling_edges(broken_edges(spark, d), fx.nodes(spark, d))


@query("SELECT year(ts)::INTEGER AS year, count(*) AS n FROM events GROUP BY 1")
def a6_cast_times(spark, d):
    rows = tables.iso(fx.read(spark, d, "events").select(F.col("ts").cast("timestamp").alias("created_at")))
    return tables.cast_times(rows).groupBy(F.year("created_at").alias("year")).agg(F.count("*").alias("n"))


@query(f"SELECT 'nodes' AS \"table\", count(*) AS loaded, count(*) AS \"input\", count(*) AS expected, true AS ok FROM ({o.NODES}) UNION ALL SELECT 'edges', count(*), count(*), count(*) + 1, false FROM ({o.PLACES})")
def a7_a8_replace_and_verify(spark, d):
    given_n, given_e = fx.nodes(spark, d), fx.places(spark, d)
    (pn, n), (pe, e) = tables.replace(given_n, tables.fresh_path(spark, "nodes"), "entity_type"), tables.replace(given_e, tables.fresh_path(spark, "edges"), "_type")
    manifest = spark.createDataFrame([("nodes", n), ("edges", e + 1)], "`table` string, expected long")
    return upsert.verify_load(spark.read.parquet(pn), spark.read.parquet(pe), given_n, given_e, manifest)


@query("""SELECT 'uid' AS rule, 'User:' || user_id AS value, count(*) AS n, ['User'] AS labels FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1
UNION ALL SELECT 'canonical_id', 'User:' || user_id, count(*), ['User'] FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1""")
def a9_duplicate_ids(spark, d):
    rows = fx.read(spark, d, "events").where("user_id is not null").select(fx.uid("User", "user_id").alias("uid"), F.lit("User").alias("entity_type"), F.col("user_id").cast("string").alias("canonical_id"))
    return upsert.duplicate_ids(rows)


@query(f"SELECT 'P' || l_partkey AS _from, 'NEAR' AS _type, 'P' || l_suppkey AS _to, min(l_orderkey) AS seq FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1, 2, 3")
def a10_dedup_edges(spark, d):
    rows = fx.read(spark, d, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("_from"), F.lit("NEAR").alias("_type"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("_to"), F.col("l_orderkey").alias("seq"))
    return upsert.dedup_edges(rows, "seq")


@query(f"SELECT entity_type AS value, count(*) AS n FROM ({o.NODES}) GROUP BY 1")
def a11_report_sink(spark, d):
    path = tables.fresh_path(spark, "report")
    tables.write_report(report.counts_by(fx.nodes(spark, d), "entity_type"), path)
    return spark.read.schema("dimension string, value string, n long").json(path).select("value", "n")


# ---------------------------------------------------------------- contract


STAMPED = """1::BIGINT AS Dv_created, 1::BIGINT AS Tv_created, 2::BIGINT AS schema_version, '2002-06-01 00:00:00' AS created_at, '2002-06-01 00:00:00' AS updated_at, '2002-06-01 00:00:00' AS ingested_at, '2002-06-01 00:00:00' AS valid_from, NULL::VARCHAR AS valid_to,
'star' AS source, NULL::VARCHAR AS source_url, NULL::VARCHAR AS source_retrieved_at"""
TIMES = ("created_at", "updated_at", "ingested_at", "valid_from", "valid_to", "source_retrieved_at")


def text(x: str) -> str:
    return f"coalesce('\"' || {x} || '\"', 'null')"


def plain_times(rows: DataFrame) -> DataFrame:
    return rows.withColumns({t: F.date_format(t, "yyyy-MM-dd HH:mm:ss") for t in TIMES})


@query(f"""SELECT * EXCLUDE (name, category, amount), entity_type || ':' || canonical_id AS check_uid, [] ::VARCHAR[] AS synonyms, []::VARCHAR[] AS ontology_refs, CASE WHEN name IS NULL THEN ['star'] ELSE [name] END AS source_ids, 1::BIGINT AS source_priority, false AS is_synthetic, NULL::VARCHAR AS synthesis_method,
NULL::VARCHAR AS synthesis_seed_uid, 'core' AS layer, {STAMPED}, sha256('{{"category":' || {text("category")} || ',"name":' || {text("name")} || '}}') AS record_hash FROM ({o.NODES})""")
def c1_stamp_nodes(spark, d):
    """Every stamped column. The name stands for the id at the source; where there is none, the source does."""
    now = F.to_timestamp(F.lit("2002-06-01 00:00:00"))
    prov = contract.provenance(F.lit("star"), F.lit(1), F.lit(False), F.lit(None).cast("string"), ids=F.array_compact(F.array("name")))
    rows = plain_times(contract.stamp_nodes(fx.nodes(spark, d), F.col("entity_type"), now, prov, ["name", "category"]))
    return rows.drop("name", "category", "amount").withColumn("check_uid", F.concat_ws(":", "entity_type", "canonical_id"))


@query(f"""SELECT _from, _type, _to, substr(sha256(_from || '|' || _type || '|' || _to), 1, 32) AS edge_id, 2::BIGINT AS source_priority, ['star'] AS source_ids, []::VARCHAR[] AS dataset_ids, publication_year < 1998 AS is_synthetic, CASE WHEN publication_year < 1998 THEN 'statistical_distribution' END AS synthesis_method,
'evidence' AS layer, {STAMPED}, sha256('{{"n":' || n || ',"neg_count":' || neg_count || ',"pos_count":' || pos_count || '}}') AS record_hash FROM ({o.SCORED})""")
def c2_stamp_edges(spark, d):
    synthetic = F.col("publication_year") < 1998
    prov = contract.provenance(F.lit("star"), F.lit(2), synthetic, F.when(synthetic, "statistical_distribution"))
    rows = contract.stamp_edges(scored(spark, d), F.to_timestamp(F.lit("2002-06-01 00:00:00")), prov, ["n", "pos_count", "neg_count"], layer="evidence")
    names = ["_from", "_type", "_to", "edge_id", "source_priority", "source_ids", "dataset_ids", "is_synthetic", "synthesis_method", "layer", "Dv_created", "Tv_created", "schema_version", *TIMES, "source", "source_url", "record_hash"]
    return plain_times(rows).select(*names)


@query(f"""SELECT uid, sha256('{{"canonical_id":"' || canonical_id || '","entity_type":"' || entity_type || '"}}') AS record_hash FROM ({o.NODES})""")
def c3_record_hash(spark, d):
    return fx.nodes(spark, d).select("uid", contract.record_hash("entity_type", "canonical_id").alias("record_hash"))


def label_specs(spark):
    rows = [("Customer", "core", True, ["name", "category"]), ("Supplier", "core", True, ["name", "category"]), ("Part", "core", False, ["name"]), ("Order", "evidence", True, []), ("Nation", "core", True, ["name"])]
    return spark.createDataFrame(rows, "label string, layer string, species_agnostic boolean, required array<string>")


BARE = "entity_type IN ('Region', 'Nation') AND canonical_id::INT % 2 = 0"


@query(f"""WITH n AS ({o.NODES}) SELECT uid, 'missing type field category' AS problem FROM n WHERE entity_type = 'Supplier' UNION ALL SELECT uid, 'missing species' FROM n WHERE entity_type = 'Part'
UNION ALL SELECT uid, 'layer mismatch' FROM n WHERE entity_type = 'Order' UNION ALL SELECT uid, 'unknown label Region' FROM n WHERE entity_type = 'Region' UNION ALL SELECT uid, 'missing ' || unnest(['source', 'layer', 'record_hash', 'updated_at']) FROM n WHERE {BARE}
UNION ALL SELECT uid, 'layer mismatch' FROM n WHERE {BARE} AND entity_type = 'Nation' UNION ALL SELECT uid, 'synthetic without method' FROM n WHERE entity_type = 'Customer' AND canonical_id::INT % 3 = 0""")
def c4_node_violations(spark, d):
    """Some nodes of a known and of an unknown label lack required fields; some are synthetic with an empty method."""
    bare, rows = F.expr(BARE), stamped_nodes(spark, d).withColumn("species", F.lit(None).cast("long"))
    fake = F.expr("entity_type = 'Customer' AND canonical_id::INT % 3 = 0")
    rows = rows.withColumns({c: F.when(~bare, F.col(c)) for c in ("source", "layer", "record_hash", "updated_at")}).withColumns({"is_synthetic": F.col("is_synthetic") | fake, "synthesis_method": F.when(fake, "")})
    return contract.node_violations(rows, label_specs(spark))


@query(f"""SELECT entity_type, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS rejected FROM (SELECT entity_type, entity_type NOT IN ('Supplier', 'Part', 'Region') AND canonical_id <> '7' AS ok
FROM (SELECT entity_type, CASE WHEN canonical_id = '7' THEN '7' ELSE canonical_id END AS canonical_id FROM ({o.NODES}))) GROUP BY 1""")
def c5_rejections(spark, d):
    rows = fx.nodes(spark, d).withColumn("canonical_id", F.when(F.col("canonical_id") == "7", " ").otherwise(F.col("canonical_id"))).withColumn("species", F.lit(None).cast("long"))
    judged = contract.judged_nodes(rows, label_specs(spark)).select("entity_type", (F.size("reasons") == 0).alias("ok"))
    return judged.groupBy("entity_type").agg(F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("rejected"))


@query(f"""SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN publication_year = 1995 THEN ['self-loop'] ELSE [] END || CASE WHEN edge_quality_tier = 'Tier 4' THEN ['missing SA'] ELSE [] END || CASE WHEN publication_year <> 1995 AND edge_quality_tier <> 'Tier 4' THEN ['valid'] ELSE [] END || ['missing formula']) AS reason FROM ({o.SCORED}))
WHERE reason <> 'valid' GROUP BY 1 UNION ALL SELECT 'valid', count(*) FROM ({o.SCORED}) WHERE publication_year <> 1995 AND edge_quality_tier <> 'Tier 4'""")
def c5_edge_rejections(spark, d):
    """Reasons of rejected edges where a required field has no column, and edges that pass without it, both in one pass over the edges."""
    rows = stamped_edges(spark, d)
    rows = rows.withColumns({"_to": F.when(F.col("publication_year") == 1995, F.col("_from")).otherwise(F.col("_to")), "SA": F.when(F.col("edge_quality_tier") != "Tier 4", F.col("SA"))})
    good, bad = contract.edge_reasons(rows), contract.edge_reasons(rows, [*schema.EDGE_REQUIRED, "formula"])
    found = rows.select(F.explode(F.concat(bad, F.when(F.size(good) == 0, F.array(F.lit("valid"))).otherwise(F.array().cast("array<string>")))).alias("reason"))
    counted = found.groupBy("reason").agg(F.count("*").alias("n"))
    return counted.unionByName(spark.createDataFrame([("valid", 0)], "reason string, n long")).groupBy("reason").agg(F.sum("n").alias("n"))  # valid is told even if there is none


@query("""SELECT o_orderkey::VARCHAR AS uid, 'source_priority must be 1 or 2' AS problem FROM orders WHERE o_orderpriority LIKE '3%' UNION ALL SELECT o_orderkey::VARCHAR, 'synthetic without method' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey::VARCHAR, 'empty source' FROM orders WHERE o_orderkey % 9 = 0""")
def c6_provenance_rules(spark, d):
    rows = fx.read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("uid"), F.when(F.col("o_orderpriority").startswith("3"), 3).otherwise(1).alias("source_priority"), (F.col("o_orderstatus") == "F").alias("is_synthetic"), F.lit(None).cast("string").alias("synthesis_method"), F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise("star").alias("source"))
    return contract.provenance_violations(rows)


@query(f"SELECT 'star' AS source, true AS is_synthetic, 'ontology_derived' AS synthesis_method, uid AS synthesis_seed_uid FROM ({o.NODES}) WHERE entity_type = 'Nation'")
def c7_derived_provenance(spark, d):
    rows = stamped_nodes(spark, d).where("entity_type = 'Nation'").withColumns(contract.derived("ontology_derived", F.col("uid")))
    return rows.select("source", "is_synthetic", "synthesis_method", "synthesis_seed_uid")


@query(f"SELECT entity_type, count(*) AS n FROM ({o.NODES}) WHERE entity_type <> 'Region' GROUP BY 1")
def c8_strict_gate(spark, d):
    specs = label_specs(spark).withColumns({"layer": F.lit("core"), "species_agnostic": F.lit(True), "required": F.array().cast("array<string>")})
    rows = stamped_nodes(spark, d).where("entity_type <> 'Region'").withColumn("species", F.lit(None).cast("long"))
    contract.gate(upsert.duplicate_ids(rows), contract.node_violations(rows, specs))
    return rows.groupBy("entity_type").agg(F.count("*").alias("n"))


def rel_specs(spark):
    rows = [("BUYS_BULK", "Customer", "Supplier"), ("SUPPLIES", "Supplier", "Part"), ("LOCATED_IN", "Customer", "Nation"), ("IN_REGION", "Nation", "Region"), ("OWNS", "Nation", "Part")]
    return spark.createDataFrame(rows, "type string, from_label string, to_label string")


@query(f"SELECT _from, _type, _to, from_label, to_label FROM ({o.PLACES}) WHERE from_label = 'Supplier' UNION ALL {o.CHAIN}")
def c9_nonconforming_edges(spark, d):
    edges = reduce(DataFrame.unionByName, [fx.places(spark, d), fx.bulk(spark, d), fx.brand_chain(spark, d)]).select("_from", "_type", "_to")
    return contract.nonconforming(contract.labelled(edges, fx.nodes(spark, d)), rel_specs(spark))


@query(f"""WITH declared AS (SELECT * FROM (VALUES ('BUYS_BULK', 'Customer', 'Supplier'), ('SUPPLIES', 'Supplier', 'Part'), ('LOCATED_IN', 'Customer', 'Nation'), ('IN_REGION', 'Nation', 'Region'), ('OWNS', 'Nation', 'Part')) t(type, from_label, to_label)),
found AS (SELECT DISTINCT _type AS type, from_label, to_label, 1 AS built FROM ({o.PLACES} UNION ALL {o.BULK}))
SELECT count(*) AS declared, count(built) AS built, coalesce(list_sort(list(type || '|' || from_label || '|' || to_label) FILTER (built IS NULL)), []) AS unbuilt FROM declared LEFT JOIN found USING (type, from_label, to_label)""")
def c10_coverage(spark, d):
    return contract.coverage(fx.places(spark, d).unionByName(fx.bulk(spark, d)), rel_specs(spark))


# ---------------------------------------------------------------- graph


@query(f"SELECT (SELECT count(*) FROM ({o.NODES})) AS nodes, (SELECT count(*) FROM ({o.BULK})) AS edges, (SELECT count(DISTINCT _type) FROM ({o.BULK})) AS types")
def e1_totals(spark, d):
    return graph.totals(fx.nodes(spark, d), fx.bulk(spark, d))


@query("SELECT count(*) AS components, max(n) AS largest, sum(n)::BIGINT AS covered FROM (SELECT count(*) AS n FROM part GROUP BY p_brand HAVING count(*) > 1)")
def e2_components_of_chains(spark, d):
    return graph.component_summary(structure(spark, d), ["BUYS_BULK", "SUPPLIES", "PREFERS"])


# every edge of BULK touches a supplier, so suppliers that share a neighbour tell the components
@query(f"""WITH RECURSIVE touch AS MATERIALIZED (SELECT _to AS s, _from AS n FROM ({o.BULK}) WHERE _type = 'BUYS_BULK' UNION SELECT _from, _to FROM ({o.BULK}) WHERE _type = 'SUPPLIES'),
near AS MATERIALIZED (SELECT DISTINCT a.s AS a, b.s AS b FROM touch a JOIN touch b USING (n)), reach(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
root AS MATERIALIZED (SELECT a AS s, min(b) AS r FROM reach GROUP BY 1), nodes AS (SELECT s AS node, r FROM root UNION SELECT n, r FROM touch JOIN root USING (s))
SELECT count(*) AS components, max(n) AS largest, sum(n)::BIGINT AS covered FROM (SELECT r, count(*) AS n FROM nodes GROUP BY 1)""")
def e2_components(spark, d):
    return graph.component_summary(fx.bulk(spark, d))


ADJ = f"SELECT DISTINCT _from, _to FROM ({o.BULK} UNION ALL {o.CHAIN})"
LEVELS = "".join(f", l{i} AS (SELECT DISTINCT s, b._to AS t FROM l{i - 1} a JOIN adj b ON a.t = b._from)" for i in range(1, 5))


@query(f"""WITH adj AS MATERIALIZED ({ADJ}), pairs AS (SELECT DISTINCT _from AS s, _to AS t FROM ({o.PREFERS}) ORDER BY 1, 2 LIMIT 150), l0 AS (SELECT DISTINCT s, s AS t FROM pairs){LEVELS},
hit AS (SELECT s, t, min(h) AS h FROM (SELECT *, 1 AS h FROM l1 UNION ALL SELECT *, 2 FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4) GROUP BY 1, 2)
SELECT count(*) AS pairs, count(h) AS with_path, round(avg(h), 4) AS mean_length FROM pairs LEFT JOIN hit USING (s, t)""")
def e3_alternative_paths(spark, d):
    return graph.alternative_paths(structure(spark, d), "PREFERS")


@query(f"""WITH b AS ({o.BULK}), c AS (SELECT DISTINCT _from AS s FROM b WHERE _type = 'BUYS_BULK' ORDER BY 1 LIMIT 10), r AS (SELECT s, count(DISTINCT y._to) AS n FROM c JOIN b x ON x._from = s AND x._type = 'BUYS_BULK' JOIN b y ON y._from = x._to AND y._type = 'SUPPLIES' GROUP BY 1)
SELECT count(*) AS sources, count(n) AS reaching, round(avg(n), 4) AS mean_reach, round(100 * round(avg(n), 4) / (SELECT count(*) FROM part), 2) AS reach_pct FROM c LEFT JOIN r USING (s)""")
def e4_hub_reach(spark, d):
    return graph.hub_reach(fx.bulk(spark, d), "BUYS_BULK", "SUPPLIES", fx.read(spark, d, "part").count())


def hubs(with_preferred: bool) -> str:
    """Components of the structure: every edge touches a supplier or a part, and the parts of a brand are one chain; so suppliers and brands that share a neighbour tell them."""
    preferred = "UNION SELECT p_brand, _from FROM pref JOIN brand USING (_to)" if with_preferred else ""
    return f"""WITH RECURSIVE b AS MATERIALIZED ({o.BULK}), pref AS MATERIALIZED ({o.PREFERS}), brand AS MATERIALIZED (SELECT 'Part:' || p_partkey AS _to, p_brand FROM part),
touch AS MATERIALIZED (SELECT _to AS h, _from AS x FROM b WHERE _type = 'BUYS_BULK' UNION SELECT _from, _from FROM b WHERE _type = 'SUPPLIES' UNION SELECT p_brand, _from FROM b JOIN brand USING (_to) WHERE _type = 'SUPPLIES'
  UNION SELECT p_brand, p_brand FROM part GROUP BY 1 HAVING count(*) > 1 {preferred}),
near AS MATERIALIZED (SELECT DISTINCT a.h AS a, b.h AS b FROM touch a JOIN touch b USING (x)), reach(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a)
SELECT count(DISTINCT m) AS n FROM (SELECT a, min(b) AS m FROM reach GROUP BY 1)"""


@query(f"""WITH r AS (SELECT (SELECT count(*) FROM ({o.PREFERS})) AS cognate_edges, p.*, h.*, (SELECT n FROM ({hubs(True)})) AS components_with, (SELECT n FROM ({hubs(False)})) AS components_without, round(100 * with_path / pairs, 1) AS pct_with_path
FROM ({SQL["e3_alternative_paths"]}) p, ({SQL["e4_hub_reach"]}) h)
SELECT *, CASE WHEN pct_with_path <= 80 THEN 'NOT CONFIRMED' WHEN mean_length <= 2.2 OR reach_pct > 20 THEN 'SEVERE' ELSE 'CONFIRMED BUT BOUNDED' END AS verdict FROM r""")
def e5_e6_gap_report(spark, d):
    ensure_checkpoint_dir(spark)
    return graph.gap_report(structure(spark, d).checkpoint(), "PREFERS", "BUYS_BULK", "SUPPLIES", fx.read(spark, d, "part").count())


@query("""WITH r AS (SELECT CASE WHEN count(*) > 0 THEN ['Customer'] ELSE [] END AS reachable FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT (SELECT count(*) FROM orders) AS subjects, (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS with_membership, reachable, list_has_any(reachable, ['Customer', 'Region']) AS has_customer, list_has_any(reachable, ['Nation']) AS has_place FROM r""")
def e7_membership_coverage(spark, d):
    return graph.membership_coverage(fx.nodes(spark, d), fx.contents(spark, d), "Order", "CONTAINS", {"has_customer": ["Customer", "Region"], "has_place": ["Nation"]})


def plan(spark):
    return schema.retirements(spark, fx.RETIRED)


@query(f"SELECT _type, count(*) AS n FROM ({o.V1}) WHERE _type <> 'BUYS_FROM' GROUP BY 1")
def e8_retired_counts(spark, d):
    return graph.retired_counts(fx.first_version(spark, d), plan(spark))


@query(o.V2)
def e9_migrate_edges(spark, d):
    return migrate.migrate(fx.first_version(spark, d), plan(spark), "weight")


SUCCESSORS = "(VALUES ('BUYS_FROM'), ('LOCATED_IN'), ('KEEPS'), ('RETURNS')) t(type)"


@query(f"""WITH before AS (SELECT DISTINCT least(from_label, to_label) AS a, greatest(from_label, to_label) AS b FROM ({o.V1})), after AS (SELECT DISTINCT least(split_part(_from, ':', 1), split_part(_to, ':', 1)) AS a, greatest(split_part(_from, ':', 1), split_part(_to, ':', 1)) AS b FROM ({o.V2}))
SELECT 'pair lost' AS problem, a || '|' || b AS detail FROM before ANTI JOIN after USING (a, b) UNION ALL SELECT 'successor not active', type FROM {SUCCESSORS} WHERE type NOT IN ('BUYS_FROM', 'LOCATED_IN', 'KEEPS')
UNION ALL SELECT 'retired left', _type || '|' || count(*) FROM ({o.V2}) WHERE _type IN ('PURCHASED_FROM', 'SOLD_TO', 'HOSTS', 'KEPT_BY', 'RETURNED_BY') GROUP BY _type""")
def e10_migration_coverage(spark, d):
    before = fx.first_version(spark, d)
    active = spark.createDataFrame([("BUYS_FROM",), ("LOCATED_IN",), ("KEEPS",)], "type string")
    return migrate.coverage_problems(before, migrate.migrate(before, plan(spark), "weight"), plan(spark), active)


@query(f"WITH a AS (SELECT count(*) AS before, count(*) FILTER (_type <> 'BUYS_FROM') AS retired FROM ({o.V1})), b AS (SELECT count(*) AS after FROM ({o.V2})) SELECT before, after, retired, before - after AS removed, round(100 * (before - after) / before, 2) AS removed_pct FROM a, b")
def e11_migration_impact(spark, d):
    before = fx.first_version(spark, d)
    return migrate.impact(before, migrate.migrate(before, plan(spark), "weight"), plan(spark))


@query(f"WITH e AS ({o.PLACES}), d AS (SELECT uid, count(*) AS d FROM (SELECT _from AS uid FROM e UNION ALL SELECT _to FROM e) GROUP BY 1) SELECT entity_type, count(*) AS nodes, round(avg(coalesce(d, 0)), 4) AS mean_degree, max(coalesce(d, 0)) AS max_degree FROM ({o.NODES}) LEFT JOIN d USING (uid) GROUP BY 1")
def e12_degree_by_label(spark, d):
    return graph.degree_by_label(fx.nodes(spark, d), fx.places(spark, d))


@query(f"SELECT count(*) AS hubs, sum(n * (n - 1) // 2)::BIGINT AS incidences FROM (SELECT hub, count(DISTINCT a) AS n FROM (SELECT _from AS a, _to AS hub FROM ({o.PLACES}) WHERE to_label = 'Nation' UNION ALL SELECT _to, _from FROM ({o.PLACES}) WHERE from_label = 'Nation') GROUP BY 1)")
def e13_hub_pairs(spark, d):
    return graph.hub_pairs(fx.places(spark, d), "Nation")


@query(f"WITH e AS (SELECT * FROM ({o.PLACES} UNION ALL {o.BULK}) WHERE from_label <> 'Nation' AND to_label <> 'Nation') SELECT (SELECT count(*) FROM e) AS edges, (SELECT count(DISTINCT u) FROM (SELECT _from AS u FROM e UNION ALL SELECT _to FROM e)) AS nodes")
def e14_projection(spark, d):
    return graph.projection_size(fx.places(spark, d).unionByName(fx.bulk(spark, d)), ["Nation"])


SUPPLIED = o.near(o.BULK, ["Supplier"])


def shared_suppliers(spark, d):
    return neighbours.adjacency(fx.bulk(spark, d), hub_labels=["Supplier"])


@query(f"WITH near AS MATERIALIZED ({SUPPLIED}) SELECT x.a, y.a AS b, count(*) AS n_common FROM near x JOIN near y USING (hub) WHERE x.a < y.a GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 100")
def t10_common_neighbours(spark, d):
    return neighbours.top_common(shared_suppliers(spark, d), 100)


@query(f"WITH near AS MATERIALIZED ({SUPPLIED}), pairs AS (SELECT x.a, y.a AS b, count(*) AS n_common FROM near x JOIN near y USING (hub) WHERE x.a < y.a GROUP BY 1, 2) SELECT n_common, count(*) AS pairs FROM pairs GROUP BY 1")
def t10_shared_counts(spark, d):
    return neighbours.pair_counts(shared_suppliers(spark, d))


HUBS = ["Nation", "Supplier"]


@query(f"WITH near AS MATERIALIZED ({o.near(f'{o.PLACES} UNION ALL {o.BULK}', HUBS)}), pairs AS (SELECT x.a, y.a AS b, count(*) AS n FROM near x JOIN near y USING (hub) WHERE x.a < y.a GROUP BY 1, 2) SELECT count(*) AS pairs, sum(n)::BIGINT AS incidences FROM pairs")
def e13_exact_pairs(spark, d):
    edges = fx.places(spark, d).unionByName(fx.bulk(spark, d))
    return neighbours.shared_pairs(neighbours.adjacency(edges, HUBS))


ALIKE = 0.5
TANIMOTO = f"""f AS MATERIALIZED ({o.FINGERPRINTS}), classes AS MATERIALIZED (SELECT bits, min(id) AS c, count(*) AS size FROM f WHERE len(bits) > 0 GROUP BY 1), each AS MATERIALIZED (SELECT c, unnest(bits) AS bit, len(bits) AS n FROM classes),
met AS (SELECT x.c AS a, y.c AS b, count(*) AS same, any_value(x.n + y.n) AS n FROM each x JOIN each y USING (bit) WHERE x.c < y.c GROUP BY 1, 2), pairs AS MATERIALIZED (SELECT a, b, round(same / (n - same)::DOUBLE, 6) AS similarity FROM met WHERE same >= {ALIKE} * (n - same) - 1e-9)"""


@query(f"WITH {TANIMOTO} SELECT a, b, similarity FROM pairs")
def sim03_tanimoto_pairs(spark, d):
    return similarity.similar_classes(similarity.Fingerprints(fx.fingerprints(spark, d)), ALIKE)


@query(f"""WITH {TANIMOTO}, ends AS (SELECT a AS c, b AS x, similarity FROM pairs UNION ALL SELECT b, a, similarity FROM pairs), near AS (SELECT ends.c, sum(size) AS n, max(similarity) AS s FROM ends JOIN classes k ON k.c = x GROUP BY 1)
SELECT id, c AS class_id, len(f.bits)::INTEGER AS n_bits, (size - 1 + coalesce(n, 0))::BIGINT AS n_similar, CASE WHEN size > 1 THEN 1 ELSE s END::DOUBLE AS best FROM f JOIN classes USING (bits) LEFT JOIN near USING (c)""")
def sim03_tanimoto_members(spark, d):
    return similarity.members(similarity.Fingerprints(fx.fingerprints(spark, d)), ALIKE)


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({o.STRENGTHS}), walk(start, node, hops, product) AS (SELECT 'Supplier:' || s_suppkey, 'Supplier:' || s_suppkey, 0, 1::DOUBLE FROM supplier UNION ALL SELECT start, _to, hops + 1, product * es FROM walk JOIN e ON node = _from WHERE hops < 4)
SELECT start, node, arg_max(hops, (product / hops, -hops))::INTEGER AS hops, round(max(product / hops), 6) AS score FROM walk WHERE hops > 0 AND start <> node GROUP BY 1, 2""")
def r15_best_paths(spark, d):
    starts = fx.read(spark, d, "supplier").select(fx.uid("Supplier", "s_suppkey").alias("start"))
    return paths.best_paths(fx.strengths(spark, d), starts).select("start", "node", "hops", F.round("score", 6).alias("score"))


NET = f"{o.BULK} UNION ALL {o.CHAIN}"
SAMPLE = "SELECT 'Supplier:' || s_suppkey AS node FROM supplier ORDER BY md5('Supplier:' || s_suppkey), 1 LIMIT 20"
REACH = 6


def sampled_betweenness(spark, d):
    """Estimated from 20 sources, by paths of up to REACH hops."""
    sources = fx.read(spark, d, "supplier").select(fx.uid("Supplier", "s_suppkey").alias("node"))
    edges = fx.bulk(spark, d).unionByName(fx.brand_chain(spark, d))
    return edges, centrality.betweenness(edges, sources.orderBy(F.md5(F.col("node").cast("binary")), "node").limit(20), REACH)


BETWEEN = f"SELECT node, {o.r4('betweenness')} AS betweenness FROM ({o.betweenness(NET, SAMPLE, REACH)})"


@query(BETWEEN)
def n02_betweenness(spark, d):
    return sampled_betweenness(spark, d)[1].withColumn("betweenness", scoring.rounded(F.col("betweenness")))


CENTRAL = 0.9
EXACT = f"SELECT node, {o.r4('betweenness')} AS betweenness FROM ({o.all_betweenness(NET)})"


def quantile(table: str, column: str) -> str:
    return f"(SELECT {column} FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) AS r, count(*) OVER () AS n FROM {table}) WHERE r = ceil(round({CENTRAL} * n, 9)))"


@query(f"""WITH degree AS MATERIALIZED (SELECT a AS node, count(DISTINCT b) AS degree FROM (SELECT _from AS a, _to AS b FROM ({NET}) UNION ALL SELECT _to, _from FROM ({NET})) WHERE a <> b GROUP BY 1), c AS MATERIALIZED (SELECT * FROM degree JOIN ({EXACT}) USING (node)),
t AS (SELECT {quantile("c", "degree")} AS d, {quantile("c", "betweenness")} AS b)
SELECT CASE WHEN degree >= d AND betweenness >= b THEN 'hub' WHEN degree >= d THEN 'local hub' WHEN betweenness >= b THEN 'structural bottleneck' ELSE 'peripheral' END AS role, split_part(node, ':', 1) AS label, count(*) AS n FROM c, t GROUP BY 1, 2""")
def n01_n02_role_matrix(spark, d):
    """Both thresholds and all roles from exact betweenness: every node is a source, and paths may be of any length."""
    edges = fx.bulk(spark, d).unionByName(fx.brand_chain(spark, d))
    between = centrality.betweenness(edges)
    found = centrality.role_matrix(edges, between.withColumn("betweenness", scoring.rounded(F.col("betweenness"))), CENTRAL)
    return found.groupBy("role", F.split_part("node", F.lit(":"), F.lit(1)).alias("label")).agg(F.count("*").alias("n"))


@query(f"""WITH e AS MATERIALIZED (SELECT _from AS a, _to AS b, c_mktsegment AS m FROM ({o.BUYS}) JOIN customer ON _from = 'Customer:' || c_custkey WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')), w AS (SELECT DISTINCT * FROM (SELECT a, b, m FROM e UNION ALL SELECT b, a, m FROM e)),
d AS MATERIALIZED (SELECT a AS node, count(DISTINCT b) FILTER (m = 'BUILDING') AS x, count(DISTINCT b) FILTER (m = 'HOUSEHOLD') AS y FROM w GROUP BY 1), n AS (SELECT count(*) FILTER (x > 0) AS n, count(*) FILTER (y > 0) AS k FROM d)
SELECT node, round(x / (n - 1), 6) AS first, round(y / (k - 1), 6) AS second, round(abs(x / (n - 1) - y / (k - 1)), 6) AS separation FROM d, n""")
def n10_separation(spark, d):
    """Two segments of customers stand for the cohorts of disease and control."""
    segment = fx.read(spark, d, "customer").select(fx.uid("Customer", "c_custkey").alias("_from"), "c_mktsegment")
    edges = fx.purchases(spark, d).join(segment, "_from").select("_from", "_to", (F.col("c_mktsegment") == "BUILDING").alias("ill"), (F.col("c_mktsegment") == "HOUSEHOLD").alias("well"))
    found = centrality.separation(edges, "ill", "well")
    return found.select("node", *[F.round(c, 6).alias(c) for c in ("first", "second", "separation")])


# the best score of a customer, through each supplier it bought from, to each of that supplier's parts
@query(f"""WITH q AS (SELECT _from AS a, _to AS s, -log10(greatest(adj_p, 1e-300)) AS logp FROM ({o.BUYS}) WHERE adj_p > 0 AND adj_p < 1e-10), p AS (SELECT _from AS s, _to AS node, es FROM ({o.STRENGTHS}) WHERE _from LIKE 'Supplier:%' AND es >= 0.9)
SELECT a AS _from, node, {o.r4("max(logp * es)")} AS score FROM q JOIN p USING (s) GROUP BY 1, 2""")
def r21_trait_scores(spark, d):
    """Purchases of clear evidence stand for trait loci, a supplier's strongest parts for the pathway nodes behind them."""
    loci = fx.purchases(spark, d).where("adj_p < 1e-10").select("_from", "_to", "adj_p")
    reach = paths.best_paths(fx.strengths(spark, d).where("_type = 'SUPPLIES'"), loci.select(F.col("_to").alias("start")), most=1, least=0.9)
    return paths.trait_scores(loci, reach).select("_from", "node", scoring.rounded(F.col("score")).alias("score"))


@query(f"""WITH c AS (SELECT node, betweenness / max(betweenness) OVER () AS influence FROM ({BETWEEN})), p AS (SELECT _from AS node, _to AS outcome, es FROM ({o.STRENGTHS}) WHERE _from LIKE 'Supplier:%'), m AS (SELECT node, max(es) AS cr FROM p GROUP BY 1),
e AS (SELECT _to AS node, avg(ES_edge) AS mean_es FROM ({o.SCORED}) GROUP BY 1) SELECT node, {o.r4("influence * cr * mean_es")} AS score FROM c JOIN m USING (node) JOIN e USING (node)""")
def r10_biomarker_scores(spark, d):
    """Influence of a supplier in the network, its best path to any part it supplies, and the mean strength of its evidence."""
    influence = sampled_betweenness(spark, d)[1].select("node", scoring.rounded(F.col("betweenness")).alias("influence"))
    starts = fx.read(spark, d, "supplier").select(fx.uid("Supplier", "s_suppkey").alias("start"))
    reach = paths.best_paths(fx.strengths(spark, d).where("_type = 'SUPPLIES'"), starts, most=1)
    evidence = scored(spark, d).select(F.col("_to").alias("node"), "ES_edge")
    return paths.biomarker_scores(influence, reach, evidence).select("node", scoring.rounded(F.col("score")).alias("score"))


UADJ = f"SELECT DISTINCT _from, _to FROM (SELECT _from, _to FROM ({o.BULK}) UNION ALL SELECT _to, _from FROM ({o.BULK}))"


@query(f"""WITH adj AS MATERIALIZED ({UADJ}), first AS (SELECT min('Customer:' || c_custkey) AS f FROM customer), l0 AS (SELECT f AS s, f AS t FROM first){LEVELS}
SELECT t AS target, min(h)::INTEGER AS hops FROM (SELECT *, 1 AS h FROM l1 UNION ALL SELECT *, 2 FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4) WHERE t LIKE 'Part:%' GROUP BY 1 ORDER BY 2, 1 LIMIT 5""")
def e15_undirected_paths(spark, d):
    first = fx.read(spark, d, "customer").agg(F.min(fx.uid("Customer", "c_custkey"))).first()[0]
    edges = fx.bulk(spark, d).unionByName(fx.places(spark, d))
    return graph.undirected_paths(edges, first, "Part", ["Nation"], fx.nodes(spark, d))


# ---------------------------------------------------------------- ad hoc

SIGNED = f"SELECT *, CASE WHEN effect_size > 0.2 THEN 1 WHEN effect_size < -0.2 THEN -1 ELSE 0 END AS direction FROM ({o.SCORED})"


@query(f"SELECT _from, _type, _to, edge_aggregate_score FROM ({o.SCORED}) WHERE publication_year >= 1998 ORDER BY edge_aggregate_score DESC, _from, _to LIMIT 25")
def q1_real_edges(spark, d):
    return adhoc.real_edges(stamped_edges(spark, d), "Customer", "Supplier")


@query(f"SELECT _type, count(*) AS n FROM ({o.SCORED}) GROUP BY 1")
def q2_types_in_layer(spark, d):
    return adhoc.types_in_layer(stamped_edges(spark, d), "evidence")


@query(f"SELECT _type, _to, evidence_type, edge_aggregate_score, edge_quality_tier FROM ({o.SCORED}) WHERE _from = 'Customer:1'")
def q3_channels(spark, d):
    return adhoc.channels_of(stamped_edges(spark, d), "Customer:1")


@query(f"SELECT _from, _type, direction, c_acctbal AS amount FROM ({SIGNED}) JOIN customer ON _from = 'Customer:' || c_custkey WHERE _to = 'Supplier:1' AND direction <> 0")
def q4_directional(spark, d):
    return adhoc.directional(stamped_edges(spark, d), fx.nodes(spark, d), "Supplier:1", "amount")


@query(f"SELECT _from, count(DISTINCT _to) AS n, round(avg(effect_size), 3) AS mean_signal FROM ({o.SCORED}) GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20")
def q5_breadth(spark, d):
    return adhoc.breadth(stamped_edges(spark, d), "BUYS_FROM")


@query(f"SELECT _from, _type, _to, pos_count, neg_count, conflict_score FROM ({o.SCORED}) WHERE concordance_flag = 'CONTRADICTORY' AND neg_count > 0 ORDER BY conflict_score DESC, _from, _to LIMIT 25")
def q6_contradicted(spark, d):
    return adhoc.contradicted(stamped_edges(spark, d))


@query(f"SELECT _from, list_sort(list(DISTINCT _to)) AS targets FROM ({o.BULK}) WHERE _type = 'SUPPLIES' GROUP BY 1")
def q7_lists(spark, d):
    return adhoc.lists_of(fx.bulk(spark, d), "SUPPLIES")


@query(f"SELECT count(DISTINCT _type) AS types FROM ({o.BULK} UNION ALL {o.PLACES})")
def q8_fingerprint(spark, d):
    return adhoc.fingerprint(fx.bulk(spark, d).unionByName(fx.places(spark, d)))


# ---------------------------------------------------------------- manifest, capabilities, readiness


@query(f"SELECT 'edge_quality_tier' AS dimension, edge_quality_tier AS value, count(*) AS n FROM ({o.SCORED}) GROUP BY 2 UNION ALL SELECT '_type', _type, count(*) FROM ({o.SCORED}) GROUP BY 2 UNION ALL SELECT 'layer', 'evidence', count(*) FROM ({o.SCORED})")
def m1_counts(spark, d):
    return report.counts_by(stamped_edges(spark, d), "_type", "layer", "edge_quality_tier", "valid_to")


@query(f"SELECT count(*) AS total, count(*) FILTER (NOT s) AS real, count(*) FILTER (s) AS synthetic, round(100.0 * count(*) FILTER (NOT s) / greatest(count(*), 1), 2) AS real_pct, round(100.0 * count(*) FILTER (s) / greatest(count(*), 1), 2) AS synthetic_pct FROM (SELECT publication_year < 1998 AS s FROM ({o.SCORED}))")
def m2_totals(spark, d):
    return report.split_totals(stamped_edges(spark, d))


@query(f"WITH c AS (SELECT * FROM (VALUES ('Customer', 'party'), ('Supplier', 'party'), ('Nation', 'place'), ('Region', 'place'), ('Part', 'thing')) t(label, cluster)) SELECT x.cluster AS a, y.cluster AS b, count(*) AS n FROM ({o.PLACES} UNION ALL {o.BULK}) JOIN c x ON from_label = x.label JOIN c y ON to_label = y.label GROUP BY 1, 2")
def m3_cluster_volume(spark, d):
    clusters = spark.createDataFrame([("Customer", "party"), ("Supplier", "party"), ("Nation", "place"), ("Region", "place"), ("Part", "thing")], "label string, cluster string")
    return report.cluster_volume(fx.places(spark, d).unionByName(fx.bulk(spark, d)), clusters)


@query(f"WITH e AS ({o.PLACES} UNION ALL {o.BULK}) SELECT count(DISTINCT _type || '|' || from_label || '|' || to_label) AS pairs, count(DISTINCT _type) AS types, count(DISTINCT _type || '|' || from_label || '|' || to_label) FILTER (_type IN ('BUYS_BULK', 'SUPPLIES')) AS layer_pairs, count(*) AS edges, (SELECT count(DISTINCT l) FROM (SELECT from_label AS l FROM e UNION ALL SELECT to_label FROM e)) AS labels FROM e")
def m4_profile(spark, d):
    return report.profile(fx.places(spark, d).withColumn("layer", F.lit("place")).unionByName(fx.bulk(spark, d).withColumn("layer", F.lit("extension"))), "extension")


ROLES = {
    "Dataset": "Nation", "Cohort": "Customer", "cohort_state": "category", "Assertion": "Order", "promotion_decision": "category", "Publication": "Supplier", "Tissue": "Nation", "Species": "Region", "CONSERVED_IN": "LOCATED_IN", "CellType": "Region",
    "Compound": "Part", "morgan_fp": "amount", "MAPS_TO_LOCUS": "SUPPLIES", "Variant": "Supplier", "Gene": "Part", "ENCODES": "BUYS_BULK", "Protein": "Supplier", "LifecycleState": "Part",
}


def capability_status(spark, d):
    signed = F.when(F.col("effect_size") > 0.2, 1).when(F.col("effect_size") < -0.2, -1).otherwise(0)
    edges = bundled(spark, d).withColumn("direction", signed).unionByName(fx.bulk(spark, d), allowMissingColumns=True).unionByName(fx.places(spark, d), allowMissingColumns=True)
    nodes = stamped_nodes(spark, d).withColumn("source", F.when(F.col("category").isNotNull(), F.col("source")))  # what has no category has no known source
    return report.capabilities(nodes, edges, ROLES)


CAPABILITIES = f"""WITH s AS MATERIALIZED ({SIGNED}), n AS MATERIALIZED ({o.NODES}), b AS MATERIALIZED ({o.BULK}), p AS MATERIALIZED ({o.PLACES}),
ok AS (
  SELECT 'topology' AS c, (SELECT count(*) FROM n) > 100 AND (SELECT count(*) FROM s) + (SELECT count(*) FROM b) + (SELECT count(*) FROM p) > 500 AS ok
  UNION ALL SELECT 'node_metadata', count(*) FILTER (entity_type IS NULL OR canonical_id IS NULL) = 0 FROM n UNION ALL SELECT 'provenance_fields', count(*) FILTER (category IS NULL) = 0 FROM n UNION ALL SELECT 'edge_scores', count(*) >= 500 FROM s UNION ALL SELECT 'edge_tiers', count(DISTINCT edge_quality_tier) >= 2 FROM s
  UNION ALL SELECT 'edge_provenance', count(*) >= 500 FROM s UNION ALL SELECT 'edge_modality', count(DISTINCT domain) >= 3 FROM s
  UNION ALL SELECT 'edge_conflict', count(*) FILTER (neg_count > 0) >= 100 FROM s UNION ALL SELECT 'edge_direction', count(*) FILTER (direction <> 0) >= 100 FROM s UNION ALL SELECT 'edge_recency', count(DISTINCT publication_year) >= 8 FROM s
  UNION ALL SELECT 'datasets', count(*) >= 10 FROM nation UNION ALL SELECT 'cohorts', count(DISTINCT c_mktsegment) >= 2 FROM customer UNION ALL SELECT 'assertions', count(*) > 50 AND count(DISTINCT o_orderstatus) >= 2 FROM orders
  UNION ALL SELECT 'publications', count(*) > 50 FROM supplier UNION ALL SELECT 'variant_locus', count(*) >= 10 FROM b WHERE _type = 'SUPPLIES' UNION ALL SELECT 'orthologs', (SELECT count(*) FROM region) >= 2 AND count(*) > 10 FROM p WHERE _type = 'LOCATED_IN'
  UNION ALL SELECT 'lifecycle', count(DISTINCT p_name) >= 3 FROM part UNION ALL SELECT 'tissues', count(*) >= 5 FROM nation UNION ALL SELECT 'cell_types', count(*) >= 3 FROM region UNION ALL SELECT 'compound_fingerprints', count(p_retailprice) >= 20 FROM part
), names AS (SELECT unnest(['topology', 'node_metadata', 'provenance_fields', 'edge_scores', 'edge_tiers', 'edge_conflict', 'edge_direction', 'edge_provenance', 'edge_modality', 'edge_recency', 'datasets', 'cohorts', 'assertions', 'evidence_modality', 'evidence_stage',
  'evidence_batch', 'clinical_evidence', 'publications', 'variant_stats', 'variant_locus', 'qtl', 'orthologs', 'hypotheses', 'hypothesis_subgraph', 'version_history', 'mc_trajectory', 'confidence_components', 'lifecycle', 'reasoning_chains', 'biological_state', 'scan_results',
  'audit_log', 'tissues', 'cell_types', 'ontology_dag', 'drug_directional', 'off_target', 'compound_fingerprints', 'gene_protein_link', 'agriculture_data', 'embeddings']) AS c)
SELECT names.c AS capability, CASE WHEN names.c IN ('agriculture_data', 'embeddings') THEN 'UNSUPPORTED' WHEN coalesce(ok, false) THEN 'PASS' ELSE 'FAIL' END AS status FROM names LEFT JOIN ok USING (c)"""


@query(CAPABILITIES)
def k_capabilities(spark, d):
    return capability_status(spark, d).select("capability", "status")


def figures(**of: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS capability, {v} AS detail" for k, v in of.items())


def whole(x: str) -> str:
    return f"format('{{:,}}', ({x}))"


def in_table(t: str, where: str = "true", what: str = "count(*)") -> str:
    return whole(f"SELECT {what} FROM {t} WHERE {where}")


NONE = {
    "evidence_modality": "0 modalities / 0 records", "evidence_stage": "0 stages / 0 records", "evidence_batch": "0 with batch data", "clinical_evidence": "0 clinical records", "variant_stats": "0 variants", "qtl": "0 edges, 0 kinds", "hypotheses": "0 hypotheses, 0 domains",
    "hypothesis_subgraph": "0 edges", "version_history": "no rows", "mc_trajectory": "0 changes, 0 converged", "confidence_components": "0 sets", "reasoning_chains": "0 chains", "biological_state": "0 states", "scan_results": "0 results", "audit_log": "0 events, 0 types",
    "ontology_dag": "0 edges", "drug_directional": "0 edges", "off_target": "0 edges", "agriculture_data": "no entity types for agriculture", "embeddings": "no vector layer",
}
DETAILS = figures(
    topology=f"{in_table('n')} || ' nodes / ' || {whole('SELECT (SELECT count(*) FROM s) + (SELECT count(*) FROM b) + (SELECT count(*) FROM p)')} || ' edges'", node_metadata=f"{in_table('n', 'entity_type IS NULL OR canonical_id IS NULL')} || ' nodes lack fields'",
    provenance_fields=f"{in_table('n', 'category IS NULL')} || ' nodes lack fields'", edge_scores=f"{in_table('s')} || ' scored edges'", edge_tiers=f"{in_table('s', what='count(DISTINCT edge_quality_tier)')} || ' tiers over ' || {in_table('s')} || ' edges'",
    edge_conflict=f"{in_table('s', 'neg_count > 0')} || ' edges with contradiction'", edge_direction=f"{in_table('s', 'direction <> 0')} || ' directional edges'", edge_provenance=f"{in_table('s')} || ' edges with full provenance'",
    edge_modality=f"{in_table('s', what='count(DISTINCT domain)')} || ' modalities over ' || {in_table('s', what='count(domain)')} || ' edges'", edge_recency=f"{in_table('s', what='count(DISTINCT publication_year)')} || ' distinct years (' || (SELECT min(publication_year) || '-' || max(publication_year) FROM s) || ')'",
    datasets=f"{in_table('nation')} || ' data sets'", cohorts=f"{in_table('customer')} || ' cohorts, ' || {in_table('customer', what='count(DISTINCT c_mktsegment)')} || ' states'", assertions=f"{in_table('orders')} || ' assertions, ' || {in_table('orders', what='count(DISTINCT o_orderstatus)')} || ' decisions'",
    publications=f"{in_table('supplier')} || ' publications, 0 types'", variant_locus=f"{in_table('b', "_type = 'SUPPLIES'")} || ' edges'", orthologs=f"{in_table('region')} || ' species, ' || {in_table('p', "_type = 'LOCATED_IN'")} || ' edges'",
    lifecycle=f"{in_table('part', what='count(DISTINCT p_name)')} || ' states'", tissues=f"{in_table('nation')} || ' tissues'", cell_types=f"{in_table('region')} || ' cell types'", compound_fingerprints=f"{in_table('part', what='count(p_retailprice)')} || ' compounds'",
    gene_protein_link=f"{in_table('b', 'false')} || ' edges'", **{k: f"'{v}'" for k, v in NONE.items()},
)


@query(f"WITH s AS MATERIALIZED ({SIGNED}), n AS MATERIALIZED ({o.NODES}), b AS MATERIALIZED ({o.BULK}), p AS MATERIALIZED ({o.PLACES}), k AS ({CAPABILITIES}) SELECT capability, status, detail FROM k JOIN ({DETAILS}) USING (capability)")
def k_capability_details(spark, d):
    return capability_status(spark, d).select("capability", "status", "detail")


SCANS = [
    ("S-01", "core", ["PRIM_N01", "E05"]), ("S-02", "core", []), ("S-03", "core", ["V01", "E16"]), ("S-04", "evidence", ["PRIM_E16"]), ("S-05", "evidence", ["UNHEARD_OF"]), ("S-06", "evidence", ["P03"]),
    ("S-07", "state", ["PRIM_SEM_07", "CLIN_04"]), ("AG-1", "agri", ["EDIT_01"]), ("S-08", "state", None),
]
READINESS = f"""WITH k AS ({CAPABILITIES}), need AS (SELECT * FROM (VALUES ('S-01', 'core', ['topology', 'edge_conflict']), ('S-02', 'core', ['topology', 'edge_scores']), ('S-03', 'core', ['embeddings', 'edge_modality']), ('S-04', 'evidence', ['edge_modality']), ('S-05', 'evidence', ['topology']),
  ('S-06', 'evidence', ['topology', 'edge_scores']), ('S-07', 'state', ['edge_scores', 'clinical_evidence', 'orthologs']), ('S-08', 'state', ['topology', 'edge_scores'])) t(scan_id, family, caps)),
each AS (SELECT scan_id, family, unnest(caps) AS capability FROM need)
SELECT scan_id, family, CASE WHEN bool_or(status = 'UNSUPPORTED') THEN 'UNSUPPORTED' WHEN bool_or(status = 'FAIL') THEN 'BLOCKED' ELSE 'READY' END AS verdict, coalesce(list_sort(list(capability || ':' || status) FILTER (status <> 'PASS')), []) AS blockers FROM each JOIN k USING (capability) GROUP BY 1, 2"""


def readiness(spark, d):
    scans = spark.createDataFrame(SCANS, "scan_id string, family string, primitives array<string>")
    return report.verdicts(scans, report.primitive_capabilities(spark), capability_status(spark, d))


@query(READINESS)
def r1_r2_verdicts(spark, d):
    return readiness(spark, d)


@query(f"SELECT verdict, count(*) AS n, round(100.0 * count(*) / 8, 1) AS pct FROM ({READINESS}) GROUP BY 1")
def r3_summary(spark, d):
    return report.verdict_summary(readiness(spark, d))


@query(f"SELECT family, count(*) FILTER (verdict = 'READY') AS READY, count(*) FILTER (verdict = 'BLOCKED') AS BLOCKED, count(*) FILTER (verdict = 'UNSUPPORTED') AS UNSUPPORTED FROM ({READINESS}) GROUP BY 1")
def r3_by_family(spark, d):
    return report.verdicts_by_family(readiness(spark, d))


# ---------------------------------------------------------------- expansion

RULES = [(("Customer", "Customer"), 4.5), (("Nation", "Region"), 1.6), (("Part",), 2.5)]
PLANNED = f"""WITH n AS (SELECT entity_type, count(*) AS n FROM ({o.NODES}) GROUP BY 1), e AS (SELECT _type, count(*) AS c FROM ({o.PLACES} UNION ALL {o.BULK}) GROUP BY 1, from_label), r AS (SELECT * FROM (VALUES ('BUYS_BULK', 'Customer', 'Supplier', 1.2), ('SUPPLIES', 'Supplier', 'Part', 2.5), ('LOCATED_IN', 'Customer', 'Nation', 1.6), ('IN_REGION', 'Nation', 'Region', 1.6), ('OWNS', 'Nation', 'Part', 1.6)) t(type, from_label, to_label, deg)),
x AS (SELECT type, from_label, to_label, floor(n * deg::DOUBLE)::BIGINT AS planned FROM r JOIN n ON from_label = entity_type), have AS (SELECT _type AS type, from_label, to_label, count(*) AS existing FROM ({o.PLACES} UNION ALL {o.BULK}) GROUP BY 1, 2, 3),
f AS (SELECT least(1.0, greatest(0, 10000 - (SELECT sum(c) FROM e)) / sum(planned)::DOUBLE) AS f FROM x)
SELECT type, from_label, to_label, planned, greatest(1, floor(planned * f))::BIGINT AS target, coalesce(existing, 0) AS existing, greatest(0, greatest(1, floor(planned * f)) - coalesce(existing, 0))::BIGINT AS need FROM x CROSS JOIN f LEFT JOIN have USING (type, from_label, to_label)"""


@query(PLANNED)
def x1_edge_budget(spark, d):
    return expand.allocate(rel_specs(spark), fx.nodes(spark, d), fx.places(spark, d).unionByName(fx.bulk(spark, d)), 10_000, RULES)


@query()
def x2_expand_edges(spark, d):
    nodes, edges = fx.nodes(spark, d), fx.places(spark, d).unionByName(fx.bulk(spark, d))
    return expand.expand(expand.allocate(rel_specs(spark), nodes, edges, 2_000_000, RULES), nodes, edges)


MANY = PLANNED.replace("10000 -", "2000000 -")


@query(f"""WITH p AS ({MANY}), n AS (SELECT entity_type, count(*) AS n FROM ({o.NODES}) GROUP BY 1)
SELECT type AS _type, least(need, a.n * b.n - existing)::BIGINT AS made, 0::BIGINT AS loops, 0::BIGINT AS repeated, 0::BIGINT AS known FROM p JOIN n a ON a.entity_type = from_label JOIN n b ON b.entity_type = to_label WHERE need > 0""")
def x2_expansion_counts(spark, d):
    """What the expansion promises: as many edges as needed, none of them a loop, a repetition or an edge that was there."""
    nodes, edges = fx.nodes(spark, d), fx.places(spark, d).unionByName(fx.bulk(spark, d))
    made = expand.expand(expand.allocate(rel_specs(spark), nodes, edges, 2_000_000, RULES), nodes, edges)
    each = made.groupBy("_type", "_from", "_to").agg(F.count("*").alias("n")).join(edges.select("_type", "_from", "_to", F.lit(1).alias("was")).distinct(), ["_type", "_from", "_to"], "left")
    return each.groupBy("_type").agg(F.sum("n").alias("made"), F.count_if(F.col("_from") == F.col("_to")).alias("loops"), F.sum(F.col("n") - 1).alias("repeated"), F.count("was").alias("known"))


# ---------------------------------------------------------------- seeds


@query(f"SELECT ensembl_id, symbol, disease_id, name, score, genetic, literature, [name] AS therapeutic_areas FROM ({o.DISEASES})")
def b1_diseases(spark, d):
    x = seeds.target_diseases(fixture_seeds.target_responses(spark, d))
    return x.select("ensembl_id", "symbol", "disease_id", "name", "score", F.col("datatype_scores")["genetic_association"].alias("genetic"), F.col("datatype_scores")["literature"].alias("literature"), "therapeutic_areas")


@query(f"SELECT symbol, drug_id, max_clinical_stage, a AS action_type, {o.ACTIONS} AS direction, indication FROM ({o.DRUGS})")
def b1_b2_drugs(spark, d):
    x = seeds.target_drugs(fixture_seeds.target_responses(spark, d))
    return x.select("symbol", "drug_id", "max_clinical_stage", "action_type", "direction", F.explode("indications").alias("i")).select("symbol", "drug_id", "max_clinical_stage", "action_type", "direction", F.col("i.disease_id").alias("indication"))


@query(f"SELECT 'P' || l_partkey AS symbol, 'g' || l_suppkey AS target_symbol, l_returnflag AS species_id, l_linestatus = 'O' AS is_ortholog, l_quantity AS query_pct_identity FROM {o.LINES} WHERE l_linenumber <> 4")
def b1_homologues(spark, d):
    return seeds.target_homologues(fixture_seeds.target_responses(spark, d)).select("symbol", "target_symbol", "species_id", "is_ortholog", "query_pct_identity")


@query("SELECT s_suppkey::VARCHAR AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'X:' || s_suppkey || '_1' ELSE 'A:' || s_suppkey || '_1' END AS curie FROM supplier")
def b3_curies(spark, d):
    k = F.col("s_suppkey").cast("string")
    return fx.read(spark, d, "supplier").select(k.alias("k"), seeds.curie(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("X:"), k, F.lit("_1"))).otherwise(F.concat(F.lit("A_"), k, F.lit("_1")))).alias("curie"))


@query(f"SELECT a, b, score, experimental, database FROM ({o.PAIRS})")
def b4_interactions(spark, d):
    return seeds.interactions(fixture_seeds.network_responses(spark, d)).select("a", "b", "score", "experimental", "database")


VARIANTS = "SELECT 'rs' || c_custkey AS variant_id, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_nationkey::VARCHAR END AS chromosome, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey * 100 END AS base_position, c_mktsegment AS consequence FROM customer WHERE c_custkey % 10 <> 0"


@query(VARIANTS)
def b5_variants(spark, d):
    return seeds.variants(fixture_seeds.variant_responses(spark, d)).select("variant_id", "chromosome", "base_position", "consequence")


@query("SELECT 'rs' || o_custkey AS variant_id, round(o_totalprice / 1e6, 6) AS p_value, CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice / 1e5, 4) END AS beta, o_orderstatus AS risk_frequency, 'EFO:' || substr(o_orderpriority, 1, 1) AS trait_id FROM orders")
def b6_associations(spark, d):
    x = seeds.associations(fixture_seeds.association_responses(spark, d))
    return x.select("variant_id", "p_value", "beta", "risk_frequency", F.explode("traits").alias("t")).select("variant_id", "p_value", "beta", "risk_frequency", F.col("t.trait_id").alias("trait_id"))


def expression(spark, d):
    return seeds.expression(fixture_seeds.expression_responses(spark, d), F.regexp_extract("url", "x/(.*)", 1))


@query(o.EXPRESSION)
def b7_expression(spark, d):
    return expression(spark, d).select("gene_symbol", "tissue", "tissue_uberon", "median_tpm")


@query("SELECT 'MONDO:' || s_suppkey AS term_id, s_name AS name, ['OMIM:' || s_suppkey, 'OMIM:' || (s_suppkey + 1)] AS omim_ids, [s_suppkey::VARCHAR] AS doid FROM supplier WHERE s_suppkey % 11 <> 0")
def b8_terms(spark, d):
    return seeds.terms(fixture_seeds.term_responses(spark, d)).select("term_id", "name", "omim_ids", F.col("xrefs")["DOID"].alias("doid"))


def found_annotations(spark, d):
    return seeds.annotations(fixture_seeds.annotation_responses(spark, d), F.regexp_extract("url", "a/(.*)", 1))


ANNOTATED = f"SELECT l_suppkey::VARCHAR AS source_disease, 'HP:' || l_partkey AS phenotype_id, min(l_returnflag) AS category FROM {o.LINES} GROUP BY l_suppkey, l_partkey UNION ALL SELECT DISTINCT l_suppkey::VARCHAR, 'HP:plain', NULL FROM lineitem WHERE l_suppkey % 2 = 1"


@query(ANNOTATED)
def b9_annotations(spark, d):
    return found_annotations(spark, d).select("source_disease", "phenotype_id", "category")


@query(f"""WITH a AS ({ANNOTATED}), l AS (SELECT s_nationkey::VARCHAR AS disease_id, s_suppkey::VARCHAR AS source_disease, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier)
SELECT disease_id, phenotype_id, first(source_disease ORDER BY n) AS source_disease FROM l JOIN a USING (source_disease) WHERE n <= 3 GROUP BY 1, 2""")
def b9_merged_annotations(spark, d):
    links = fx.read(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("disease_id"), F.col("s_suppkey").cast("string").alias("source_disease"), F.col("s_suppkey").alias("position"))
    return seeds.merge_annotations(links, found_annotations(spark, d)).select("disease_id", "phenotype_id", "source_disease")


@query("SELECT 'PMID:' || o_orderkey AS publication_id, CASE o_orderstatus WHEN 'F' THEN 'Nature' WHEN 'O' THEN 'JAMA' ELSE 'Other' END AS journal, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate)::INTEGER END AS publication_year, '10/' || o_orderkey AS doi, o_orderstatus <> 'P' AS is_high_authority FROM orders")
def b10_publications(spark, d):
    return seeds.publications(fixture_seeds.publication_responses(spark, d)).select("publication_id", "journal", "publication_year", "doi", "is_high_authority")


@query("""SELECT p_name || '/' || p_partkey AS symbol, CASE WHEN p_partkey % 2 = 0 THEN 'H' || p_partkey WHEN p_partkey % 3 = 0 THEN 'E' || p_partkey END AS ensembl_id, CASE WHEN p_partkey % 3 = 0 THEN 'c2' ELSE 'c1' END AS chromosome, CASE WHEN p_partkey % 5 = 0 THEN 'Q' || p_partkey END AS protein_id,
list_filter(['hgnc', CASE WHEN p_partkey % 3 = 0 THEN 'ensembl' END, CASE WHEN p_partkey % 5 = 0 THEN 'uniprotkb' END], lambda x: x IS NOT NULL) AS source_ids FROM part""")
def b11_merge_genes(spark, d):
    k = F.col("p_partkey")
    p = fx.read(spark, d, "part").select(k, F.concat_ws("/", "p_name", k.cast("string")).alias("symbol"))
    s = lambda x: F.concat(F.lit(x), k.cast("string"))
    first = p.select("symbol", F.when(k % 2 == 0, s("H")).alias("ensembl_id"), F.lit("c1").alias("chromosome"), F.lit("b1").alias("biotype"))
    second = p.where(k % 3 == 0).select("symbol", s("E").alias("ensembl_id"), F.lit("c2").alias("chromosome"), F.lit(None).cast("string").alias("biotype"))
    return seeds.merge_genes(first, second, p.where(k % 5 == 0).select("symbol", s("Q").alias("protein_id"))).select("symbol", "ensembl_id", "chromosome", "protein_id", "source_ids")


@query("SELECT l_suppkey AS pathway_id, count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 120")
def b12_top_pathways(spark, d):
    return graph.top_by_count(fx.read(spark, d, "lineitem").select(F.col("l_suppkey").alias("pathway_id"), "l_partkey").distinct(), "pathway_id", 120)


@query(f"SELECT 'MONDO:' || l_suppkey AS disease_id, arg_min(l_returnflag, (l_partkey, l_returnflag)) AS name FROM {o.LINES} WHERE l_linenumber <> 7 GROUP BY 1")
def b13_first_wins(spark, d):
    x = seeds.target_diseases(fixture_seeds.target_responses(spark, d)).withColumn("at", F.substring("symbol", 2, 20).cast("long"))
    return upsert.first_wins(x, ["disease_id"], ["at", "name"]).select("disease_id", "name")


@query("SELECT p_brand || '-' || p_partkey // 100 AS protein_id, min_by('g' || p_partkey, p_partkey) AS gene_symbol, count(*) AS symbols, list_slice(list_concat(['s'], list_slice(list('g' || p_partkey ORDER BY p_partkey), 2, 1000000)), 1, 15) AS synonyms FROM part GROUP BY 1")
def b14_collapse_proteins(spark, d):
    rows = fx.read(spark, d, "part").select("p_partkey", F.concat_ws("-", "p_brand", F.floor(F.col("p_partkey") / 100).cast("string")).alias("protein_id"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("symbol"), F.col("p_name").alias("name"), F.array(F.lit("s")).alias("synonyms"))
    return seeds.collapse_proteins(rows, "p_partkey").select("protein_id", "gene_symbol", F.size("encoded_by_symbols").cast("long").alias("symbols"), "synonyms")


@query(f"SELECT variant_id, chromosome, p_raw, effect_weight FROM ({VARIANTS}) LEFT JOIN (SELECT 'rs' || o_custkey AS variant_id, first(round(o_totalprice / 1e6, 6) ORDER BY o_orderkey) AS p_raw, first(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice / 1e5, 4) END ORDER BY o_orderkey) AS effect_weight FROM orders GROUP BY 1) USING (variant_id)")
def b15_variant_statistics(spark, d):
    return seeds.variant_statistics(seeds.variants(fixture_seeds.variant_responses(spark, d)), seeds.associations(fixture_seeds.association_responses(spark, d))).select("variant_id", "chromosome", "p_raw", "effect_weight")


@query(f"""SELECT 'Gene:' || symbol AS _from, t AS _type, 'Disease:' || disease_id AS _to, CASE WHEN ch > 0.5 THEN 'curated_db' ELSE 'text_mined' END AS evidence_type, round(2 * ch, 4) AS effect_size, floor(200 + score * 4000)::BIGINT AS n
FROM (SELECT symbol, disease_id, score, 'GENETICALLY_LINKS_TO' AS t, genetic AS ch FROM ({o.DISEASES}) UNION ALL SELECT symbol, disease_id, score, 'BIOMARKER_FOR', literature FROM ({o.DISEASES}))""")
def b16_channel_edges(spark, d):
    return seeds.channel_edges(seeds.target_diseases(fixture_seeds.target_responses(spark, d))).select("_from", "_type", "_to", "evidence_type", "effect_size", "n")


@query(f"""SELECT 'Drug:' || drug_id AS _from, CASE WHEN dir < 0 THEN 'PHARMACOLOGICALLY_INHIBITS' WHEN dir > 0 THEN 'PHARMACOLOGICALLY_ACTIVATES' ELSE 'EXERTS_OFF_TARGET_EFFECT' END AS _type, 'Protein:' || symbol AS _to, dir AS direction FROM (SELECT *, {o.ACTIONS} AS dir FROM ({o.DRUGS}))
UNION ALL SELECT 'Drug:' || drug_id, 'CLINICALLY_TREATS', 'Disease:' || indication, -1 FROM ({o.DRUGS})""")
def b17_drug_edges(spark, d):
    return seeds.drug_edges(seeds.target_drugs(fixture_seeds.target_responses(spark, d))).select("_from", "_type", "_to", "direction")


@query(f"SELECT 'Gene:P' || l_partkey AS _from, 'CONSERVED_IN' AS _type, 'Species:' || l_returnflag AS _to, round(l_quantity / 50, 4) AS effect_size FROM {o.LINES} WHERE l_linenumber <> 4 AND l_linestatus = 'O' AND l_returnflag <> 'A'")
def b18_conservation_edges(spark, d):
    species = fx.read(spark, d, "lineitem").select(F.col("l_returnflag").alias("species_id")).where("species_id <> 'A'").distinct()
    return seeds.conservation_edges(seeds.target_homologues(fixture_seeds.target_responses(spark, d)), species).select("_from", "_type", "_to", "effect_size")


@query(f"SELECT 'Gene:' || a AS _from, CASE WHEN greatest(experimental, database) > 0.3 THEN 'INTERACTS_WITH' ELSE 'PREDICTED_TO_INTERACT_WITH' END AS _type, 'Gene:' || b AS _to, round(score * 2, 4) AS effect_size FROM ({o.PAIRS}) UNION ALL SELECT 'Protein:' || a, 'PROTEIN_INTERACTS_WITH', 'Protein:' || b, round(score * 2, 4) FROM ({o.PAIRS})")
def b19_interaction_edges(spark, d):
    return seeds.interaction_edges(seeds.interactions(fixture_seeds.network_responses(spark, d))).select("_from", "_type", "_to", "effect_size")


@query(f"SELECT DISTINCT 'Gene:' || p_name AS _from, 'PARTICIPATES_IN' AS _type, 'Pathway:' || l_suppkey AS _to FROM lineitem JOIN part ON l_partkey = p_partkey UNION ALL SELECT DISTINCT 'Protein:' || p_partkey, 'PROTEIN_PARTICIPATES_IN', 'Pathway:' || l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey")
def b20_membership_edges(spark, d):
    rows = fx.read(spark, d, "lineitem").select("l_partkey", F.col("l_suppkey").cast("string").alias("pathway_id")).distinct().join(fx.read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return seeds.membership_edges(rows.select(F.col("p_name").alias("gene_symbol"), F.col("p_partkey").cast("string").alias("protein_id"), "pathway_id"))


@query(f"SELECT 'Gene:' || gene_symbol AS _from, 'EXPRESSED_IN' AS _type, 'Tissue:' || tissue_uberon AS _to, round(least(2, median_tpm / 30), 4) AS effect_size FROM ({o.EXPRESSION}) WHERE median_tpm >= 1")
def b20_expression_edges(spark, d):
    return seeds.expression_edges(expression(spark, d)).select("_from", "_type", "_to", "effect_size")


@query(f"""SELECT 'Variant:' || variant_id AS _from, t AS _type, 'Gene:' || consequence AS _to, NULL::DOUBLE AS effect_size, NULL::DOUBLE AS adj_p FROM ({VARIANTS}), (VALUES ('MAPS_TO_LOCUS'), ('eQTL_MODULATES')) x(t)
UNION ALL SELECT 'Variant:rs' || o_custkey, 'GWAS_ASSOCIATED_WITH', 'Trait:EFO:' || substr(o_orderpriority, 1, 1), CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice / 1e5, 4) END, round(o_totalprice / 1e6, 6) FROM orders""")
def b21_variant_edges(spark, d):
    links = seeds.variants(fixture_seeds.variant_responses(spark, d)).select("variant_id", F.col("consequence").alias("gene_symbol"))
    return seeds.variant_edges(links, seeds.associations(fixture_seeds.association_responses(spark, d)))


@query(f"""SELECT DISTINCT 'OntologyTerm:' || n_regionkey AS _from, 'ONTOLOGICALLY_INCLUDES' AS _type, 'OntologyTerm:N' || n_nationkey AS _to FROM nation UNION ALL SELECT 'Disease:MONDO:' || s_suppkey, 'STANDARDIZED_BY_ONTOLOGY', 'OntologyTerm:MONDO:' || s_suppkey FROM supplier WHERE s_suppkey % 11 <> 0
UNION ALL SELECT DISTINCT 'Phenotype:' || phenotype_id, 'DISTINGUISHES_COHORT', 'Disease:' || source_disease FROM ({ANNOTATED})""")
def b21_ontology_edges(spark, d):
    tree = fx.read(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"), F.col("n_regionkey").cast("string").alias("parent"))
    diseases = seeds.terms(fixture_seeds.term_responses(spark, d)).select(F.col("term_id").alias("disease_id"))
    return seeds.ontology_edges(tree, diseases, found_annotations(spark, d).select("phenotype_id", F.col("source_disease").alias("disease_id")))


@query(f"SELECT drug_id, max_clinical_stage, CASE upper(max_clinical_stage) WHEN 'PHASE_1' THEN 1 WHEN 'APPROVED' THEN 4 ELSE 3 END AS max_phase, max_clinical_stage = 'approved' AS approved FROM (SELECT DISTINCT drug_id, max_clinical_stage FROM ({o.DRUGS}))")
def b22_clinical_phase(spark, d):
    x = seeds.target_drugs(fixture_seeds.target_responses(spark, d)).select("drug_id", "max_clinical_stage").distinct()
    return x.select("drug_id", "max_clinical_stage", seeds.clinical_phase(F.col("max_clinical_stage")).alias("p")).select("drug_id", "max_clinical_stage", "p.max_phase", "p.approved")
