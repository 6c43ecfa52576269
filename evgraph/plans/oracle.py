"""SQL that gives the same rows as the registered queries, over views of the same tables."""

from __future__ import annotations

from evgraph.schema import ACTION_DIRECTION, DOMAIN_MULTIPLIER, EVIDENCE_STRENGTH, SOURCE_AUTHORITY


def case(expr: str, table: dict, default) -> str:
    q = lambda v: f"'{v}'" if isinstance(v, str) else f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v)
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN {q(v)}" for k, v in table.items()) + f" ELSE {q(default)} END"


def edge(kind: str, a: tuple[str, str], b: tuple[str, str], source: str, where: str = "true") -> str:
    return f"SELECT DISTINCT '{a[0]}:' || {a[1]} AS _from, '{kind}' AS _type, '{b[0]}:' || {b[1]} AS _to, '{a[0]}' AS from_label, '{b[0]}' AS to_label FROM {source} WHERE ({where}) AND {a[1]} IS NOT NULL AND {b[1]} IS NOT NULL"


def r4(x: str) -> str:
    """To four digits, halves up."""
    return f"round(round({x}, 10)::DECIMAL(24, 10), 4)::DOUBLE"


LO = "lineitem JOIN orders ON l_orderkey = o_orderkey"
NODES = """
SELECT 'Customer:' || c_custkey AS uid, c_custkey::VARCHAR AS canonical_id, 'Customer' AS entity_type, c_name AS name, c_mktsegment AS category, c_acctbal::DOUBLE AS amount FROM customer
UNION ALL SELECT 'Supplier:' || s_suppkey, s_suppkey::VARCHAR, 'Supplier', s_name, NULL, s_acctbal FROM supplier
UNION ALL SELECT 'Part:' || p_partkey, p_partkey::VARCHAR, 'Part', p_name, p_brand, p_retailprice FROM part
UNION ALL SELECT 'Order:' || o_orderkey, o_orderkey::VARCHAR, 'Order', NULL, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT 'Nation:' || n_nationkey, n_nationkey::VARCHAR, 'Nation', n_name, NULL, NULL FROM nation
UNION ALL SELECT 'Region:' || r_regionkey, r_regionkey::VARCHAR, 'Region', r_name, NULL, NULL FROM region
"""
BUYS = f"""
SELECT 'Customer:' || o_custkey AS _from, 'BUYS_FROM' AS _type, 'Supplier:' || l_suppkey AS _to, 'Customer' AS from_label, 'Supplier' AS to_label,
  round(avg((l_discount - 0.05) * 40), 6) AS effect_size, pow(10, -max(l_extendedprice) / 10000) AS adj_p, sum(l_quantity)::BIGINT AS n,
  count(*) FILTER (l_returnflag <> 'R') AS pos_count, count(*) FILTER (l_returnflag = 'R') AS neg_count, max(year(l_shipdate))::INTEGER AS publication_year, min(o_orderpriority) AS p
FROM {LO} GROUP BY o_custkey, l_suppkey
"""
BULK = edge("BUYS_BULK", ("Customer", "o_custkey"), ("Supplier", "l_suppkey"), LO, "l_quantity >= 45") + " UNION ALL " + edge("SUPPLIES", ("Supplier", "l_suppkey"), ("Part", "l_partkey"), "lineitem", "l_quantity >= 45")
CHAIN = edge("NEXT_IN_BRAND", ("Part", "p_partkey"), ("Part", "nxt"), "(SELECT p_partkey, lead(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS nxt FROM part)")
PLACES = " UNION ALL ".join([edge("LOCATED_IN", ("Customer", "c_custkey"), ("Nation", "c_nationkey"), "customer"), edge("LOCATED_IN", ("Supplier", "s_suppkey"), ("Nation", "s_nationkey"), "supplier"), edge("IN_REGION", ("Nation", "n_nationkey"), ("Region", "n_regionkey"), "nation")])
PREFERS = edge("PREFERS", ("Customer", "o_custkey"), ("Part", "p"), f"(SELECT o_custkey, first(l_partkey ORDER BY q DESC, l_partkey) AS p FROM (SELECT o_custkey, l_partkey, sum(l_quantity) AS q FROM {LO} GROUP BY 1, 2) GROUP BY 1)")
CONTENTS = edge("CONTAINS", ("Order", "l_orderkey"), ("Part", "l_partkey"), "lineitem") + " UNION ALL " + edge("PLACED_BY", ("Order", "o_orderkey"), ("Customer", "o_custkey"), "orders")
VERSIONS = f"""
SELECT user_id AS hypothesis_id, row_number() OVER (PARTITION BY user_id ORDER BY day)::INTEGER AS Hv, {r4('least(1.0, v / 100)')} AS MC
FROM (SELECT user_id, ts::DATE AS day, round(avg(value), 6) AS v FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)
"""
EVIDENCE = {"1-URGENT": "experimental_validation", "2-HIGH": "replication", "3-MEDIUM": "curated_db", "4-NOT SPECIFIED": "text_mined", "5-LOW": "speculative"}
SOURCES = {"1-URGENT": "curated_ontology", "2-HIGH": "peer_reviewed", "3-MEDIUM": "clinical_registry", "4-NOT SPECIFIED": "preprint", "5-LOW": "blog"}
DOMAINS = {"1-URGENT": "oncology", "2-HIGH": "immunology", "3-MEDIUM": "cardiometabolic", "4-NOT SPECIFIED": "rare_disease", "5-LOW": "unlisted"}
YEAR = 2002
SCORE = r4("0.4 * least(1, abs(effect_size) / 2) + 0.4 * CASE WHEN adj_p IS NULL OR adj_p <= 0 THEN 0 ELSE greatest(0, least(1, -log10(greatest(adj_p, 1e-300)) / 10)) END + 0.2 * least(1, log10(n + 1) / 4)")
AGE = f"greatest(0, {YEAR} - publication_year)"
SIGN = "abs(" + r4("(pos_count - neg_count) / (pos_count + neg_count)::DOUBLE") + ")"
SA = r4(f"least(1, sa / ln({AGE} + exp(1)))")
RECENCY = r4(f"exp(-0.05 * rate * {AGE})")
SCORED = f"""
SELECT _from, _type, _to, from_label, to_label, effect_size, adj_p, n, pos_count, neg_count, publication_year, evidence_type, source_type, domain, agg AS edge_aggregate_score,
  {SA} AS SA, {case("evidence_type", EVIDENCE_STRENGTH, 0.5)} AS ES_edge,
  (CASE WHEN points >= 6 THEN 1.0 WHEN points >= 4 THEN 0.8 WHEN points >= 2 THEN 0.55 ELSE 0.2 END)::DOUBLE AS ES_assertion,
  CASE WHEN agg > 1 THEN 'Tier 4' WHEN agg >= 0.85 THEN 'Tier 1' WHEN agg >= 0.6 THEN 'Tier 2' WHEN agg >= 0.4 THEN 'Tier 3' ELSE 'Tier 4' END AS edge_quality_tier,
  {RECENCY} AS recency, pos_count + neg_count AS evidence_count, {r4('least(1, (pos_count + neg_count) / 6)')} AS replication_score,
  {r4('1 - abs(pos_count - neg_count) / (pos_count + neg_count)::DOUBLE')} AS conflict_score, {SIGN} AS concordance_score,
  CASE WHEN {SIGN} >= 0.5 THEN 'CONCORDANT' WHEN {SIGN} >= 0.3 THEN 'CONTEXT_DEPENDENT' ELSE 'CONTRADICTORY' END AS concordance_flag, 'Customer_BUYS_FROM_Supplier' AS edge_class
FROM (SELECT *, {SCORE} AS agg, {case("source_type", SOURCE_AUTHORITY, 0.5)} AS sa, {case("domain", DOMAIN_MULTIPLIER, 1.0)} AS rate,
    (CASE WHEN adj_p <= 0.01 THEN 2 WHEN adj_p <= 0.05 THEN 1 ELSE 0 END) + (CASE WHEN abs(effect_size) >= 1 THEN 2 WHEN abs(effect_size) >= 0.5 THEN 1 ELSE 0 END) + (CASE WHEN pos_count + neg_count >= 3 THEN 1 ELSE 0 END) + (CASE WHEN n >= 10 THEN 1 ELSE 0 END) AS points
  FROM (SELECT *, {case("p", EVIDENCE, "other")} AS evidence_type, {case("p", SOURCES, "other")} AS source_type, {case("p", DOMAINS, "other")} AS domain FROM ({BUYS}))
) WHERE agg > 0.1
"""
LATE = "l_suppkey % 3 = 0"
V1 = " UNION ALL ".join(
    f"SELECT *, {w} AS weight FROM ({sql})"
    for w, sql in (
        (1, edge("BUYS_FROM", ("Customer", "o_custkey"), ("Supplier", "l_suppkey"), LO, "l_suppkey % 2 = 0")), (2, edge("PURCHASED_FROM", ("Customer", "o_custkey"), ("Supplier", "l_suppkey"), LO, LATE)),
        (3, edge("SOLD_TO", ("Supplier", "l_suppkey"), ("Customer", "o_custkey"), LO, LATE)), (4, edge("HOSTS", ("Nation", "c_nationkey"), ("Customer", "c_custkey"), "customer")),
        (5, edge("KEPT_BY", ("Part", "l_partkey"), ("Customer", "o_custkey"), LO, "l_returnflag <> 'R'")), (6, edge("RETURNED_BY", ("Part", "l_partkey"), ("Customer", "o_custkey"), LO, "l_returnflag = 'R'")),
    )
)
V1_TARGET = {"PURCHASED_FROM": ("BUYS_FROM", False), "SOLD_TO": ("BUYS_FROM", True), "HOSTS": ("LOCATED_IN", True), "KEPT_BY": ("KEEPS", True), "RETURNED_BY": ("RETURNS", True)}
V2 = f"""
SELECT _from, _type, _to, from_label, to_label, weight, substr(sha256(_from || '|' || _type || '|' || _to), 1, 32) AS edge_id FROM (
  SELECT *, row_number() OVER (PARTITION BY _type, _from, _to ORDER BY moved, weight) AS r FROM (
    SELECT {case("_type", {k: v[0] for k, v in V1_TARGET.items()}, "BUYS_FROM")} AS _type, CASE WHEN _type IN ('SOLD_TO', 'HOSTS', 'KEPT_BY', 'RETURNED_BY') THEN _to ELSE _from END AS _from,
      CASE WHEN _type IN ('SOLD_TO', 'HOSTS', 'KEPT_BY', 'RETURNED_BY') THEN _from ELSE _to END AS _to, CASE WHEN _type IN ('SOLD_TO', 'HOSTS', 'KEPT_BY', 'RETURNED_BY') THEN to_label ELSE from_label END AS from_label,
      CASE WHEN _type IN ('SOLD_TO', 'HOSTS', 'KEPT_BY', 'RETURNED_BY') THEN from_label ELSE to_label END AS to_label, weight, _type <> 'BUYS_FROM' AS moved FROM ({V1})
  )) WHERE r = 1
"""
LINES = "(SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)"
ACTIONS = case("upper(trim(a))", ACTION_DIRECTION, 0)
DISEASES = f"SELECT 'E' || l_partkey AS ensembl_id, 'P' || l_partkey AS symbol, 'MONDO:' || l_suppkey AS disease_id, l_returnflag AS name, round(l_discount * 10, 4) AS score, round(l_tax * 10, 4) AS genetic, round(l_discount * 8, 4) AS literature FROM {LINES} WHERE l_linenumber <> 7"
DRUGS = f"SELECT 'P' || l_partkey AS symbol, 'D' || l_orderkey AS drug_id, CASE l_linenumber WHEN 1 THEN 'PHASE_1' WHEN 2 THEN 'approved' ELSE 'PHASE_3' END AS max_clinical_stage, CASE WHEN l_linenumber <> 5 THEN CASE l_returnflag WHEN 'R' THEN 'INHIBITOR' WHEN 'A' THEN ' agonist ' ELSE 'OTHER' END END AS a, 'EFO:' || l_suppkey AS indication, l_returnflag FROM {LINES} WHERE l_linenumber <> 6"
PAIRS = f"""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY least(a, b), greatest(a, b) ORDER BY u, k1, k2, k3, k4, k5, k6) AS r FROM (
    SELECT 'P' || l_partkey AS a, CASE WHEN l_linenumber <> 7 THEN 'P' || (l_suppkey * 3) END AS b, round(l_discount * 10, 4) AS score, round(l_tax * 5, 4) AS experimental, round(l_discount * 3, 4) AS database, lpad(l_partkey::VARCHAR, 12, '0') AS u,
      l_orderkey AS k1, l_linenumber AS k2, l_suppkey AS k3, l_discount AS k4, l_tax AS k5, l_quantity AS k6 FROM {LINES}
  ) WHERE score >= 0.4 AND b IS NOT NULL) WHERE r = 1
"""
EXPRESSION = f"SELECT 'P' || l_partkey AS gene_symbol, 'T' || l_suppkey AS tissue, 'UBERON:' || l_suppkey AS tissue_uberon, max(l_quantity) / 10 AS median_tpm FROM {LINES} GROUP BY l_partkey, l_suppkey HAVING max(l_quantity) % 7 <> 0"
STRENGTHS = f"""
SELECT 'Supplier:' || l_suppkey AS _from, 'Part:' || l_partkey AS _to, round(0.5 + 5 * max(l_discount), 6)::DOUBLE AS es FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY l_suppkey, l_partkey
UNION ALL SELECT _from, _to, 0.9::DOUBLE FROM ({CHAIN})
"""
FINGERPRINTS = """
SELECT p_partkey AS id, list_sort(list_distinct([('0x' || md5(x)[1:4])::INTEGER % 2048 FOR x IN [concat_ws('|', 'a', split_part(p_name, ' ', 1)), concat_ws('|', 'b', split_part(p_name, ' ', 2)), concat_ws('|', 'c', p_brand), concat_ws('|', 'd', p_type),
  concat_ws('|', 'e', p_size), concat_ws('|', 'f', split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)), concat_ws('|', 'g', p_brand, p_type), concat_ws('|', 'h', split_part(p_name, ' ', 2), p_type), concat_ws('|', 'i', split_part(p_name, ' ', 2), p_size % 10)]])) AS bits
FROM part
"""


def near(edges: str, hubs: list[str]) -> str:
    """Each node with each of its neighbours of these labels."""
    of = ", ".join(f"'{x}'" for x in hubs)
    return f"SELECT _from AS a, _to AS hub FROM ({edges}) WHERE to_label IN ({of}) UNION SELECT _to, _from FROM ({edges}) WHERE from_label IN ({of})"


def betweenness(edges: str, sources: str, most: int) -> str:
    """node, d, paths through it from the sources: levels forth, dependencies back."""
    known = lambda i: " UNION ALL ".join(f"SELECT s, node FROM l{j}" for j in range(i))
    forth = "".join(
        f"), n{i} AS (SELECT s, b AS node, sum(paths) AS paths FROM l{i - 1} JOIN both_ways ON node = a GROUP BY ALL), l{i} AS MATERIALIZED (SELECT * FROM n{i} ANTI JOIN ({known(i)}) USING (s, node)\n"
        for i in range(1, most + 1)
    )
    back = f"), d{most} AS MATERIALIZED (SELECT s, node, paths, 0::DOUBLE AS d FROM l{most}\n" + "".join(
        f"), d{i} AS MATERIALIZED (SELECT l.s, l.node, l.paths, coalesce(sum(l.paths / x.paths * (1 + x.d)), 0)::DOUBLE AS d FROM l{i} l JOIN both_ways ON l.node = a LEFT JOIN d{i + 1} x ON x.s = l.s AND x.node = b GROUP BY ALL\n"
        for i in range(most - 1, -1, -1)
    )
    every = " UNION ALL ".join(f"SELECT s, node, d FROM d{i}" for i in range(most + 1))
    return f"""WITH both_ways AS MATERIALIZED (SELECT DISTINCT a, b FROM (SELECT _from AS a, _to AS b FROM ({edges}) UNION ALL SELECT _to, _from FROM ({edges})) WHERE a <> b
), sources AS MATERIALIZED (SELECT DISTINCT node FROM ({sources}) JOIN both_ways ON node = a
), l0 AS MATERIALIZED (SELECT node AS s, node, 1::DOUBLE AS paths FROM sources
{forth}{back}), deps AS (SELECT node, sum(d) AS d FROM ({every}) WHERE s <> node GROUP BY 1)
SELECT node, coalesce(d, 0) * (SELECT count(DISTINCT a) FROM both_ways) / (2 * (SELECT count(*) FROM sources)) AS betweenness FROM (SELECT DISTINCT a AS node FROM both_ways) LEFT JOIN deps USING (node)"""


def all_betweenness(edges: str) -> str:
    """node, d, exact: from every node, by shortest paths of any length. Levels forth until none is new, then dependencies back from the last level."""
    return f"""WITH RECURSIVE both_ways AS MATERIALIZED (SELECT DISTINCT a, b FROM (SELECT _from AS a, _to AS b FROM ({edges}) UNION ALL SELECT _to, _from FROM ({edges})) WHERE a <> b
), forth(s, node, hops, paths) USING KEY (s, node) AS (SELECT DISTINCT a, a, 0, 1::DOUBLE FROM both_ways
UNION SELECT f.s, b, f.hops + 1, sum(f.paths) FROM forth f JOIN both_ways ON f.node = a WHERE NOT EXISTS (FROM recurring.forth r WHERE r.s = f.s AND r.node = b) GROUP BY ALL
), found AS MATERIALIZED (SELECT * FROM forth
), back(s, node, hops, paths, d) AS (SELECT s, node, hops, paths, 0::DOUBLE FROM found WHERE hops = (SELECT max(hops) FROM found)
UNION ALL SELECT l.s, l.node, l.hops, l.paths, coalesce(sum(l.paths / x.paths * (1 + x.d)), 0)::DOUBLE FROM found l JOIN both_ways ON l.node = a LEFT JOIN back x ON x.s = l.s AND x.node = b
  WHERE l.hops = (SELECT max(hops) - 1 FROM back) GROUP BY ALL)
SELECT node, sum(CASE WHEN s <> node THEN d ELSE 0 END) / 2 AS betweenness FROM back GROUP BY 1"""
