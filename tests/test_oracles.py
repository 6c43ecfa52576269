"""Registered queries against their SQL on the smallest tables (the rest is compared by the same rules at a larger size)."""

import glob
import math
import os

import duckdb
import pytest
from conftest import SMALL

from evgraph.plans import registry

NAMES = [
    "m1_edges_by_tier_and_flag", "d15_score_edges", "w1_w2_changes_and_stability", "a4_upsert_edges", "a5_dangling_edges", "c4_node_violations", "e2_components_of_chains", "e3_alternative_paths", "e4_hub_reach", "e9_migrate_edges",
    "e15_undirected_paths", "q5_breadth", "k_capabilities", "r1_r2_verdicts", "x1_edge_budget", "b1_diseases", "b4_interactions", "b9_annotations", "b17_drug_edges",
    "t10_common_neighbours", "sim03_tanimoto_members", "r15_best_paths", "n01_n02_role_matrix", "k_capability_details", "d15_edge_bundle",
]


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return None if math.isnan(v) else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


@pytest.fixture(scope="module")
def views():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, views, name):
    df = registry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    r = views.execute(registry.oracle_sql()[name])
    order = [x[0] for x in r.description]
    assert sorted(order) == columns
    assert got == sorted((tuple(plain(row[order.index(c)]) for c in columns) for row in r.fetchall()), key=str) and got
