"""A property graph over the star schema: the operators' labels are parameters, so any tables can play the parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.functions.scoring import looked_up, rounded

CURRENT_YEAR = 2002
# fixed values: parts that the five order priorities play
EVIDENCE = {"1-URGENT": "experimental_validation", "2-HIGH": "replication", "3-MEDIUM": "curated_db", "4-NOT SPECIFIED": "text_mined", "5-LOW": "speculative"}
SOURCES = {"1-URGENT": "curated_ontology", "2-HIGH": "peer_reviewed", "3-MEDIUM": "clinical_registry", "4-NOT SPECIFIED": "preprint", "5-LOW": "blog"}
DOMAINS = {"1-URGENT": "oncology", "2-HIGH": "immunology", "3-MEDIUM": "cardiometabolic", "4-NOT SPECIFIED": "rare_disease", "5-LOW": "unlisted"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uid(label: str, column: str):
    return F.concat(F.lit(f"{label}:"), F.col(column).cast("string"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, canonical_id, entity_type, name, category, amount of every entity."""
    t = lambda n: read(spark, sf_dir, n)
    text, number = lambda c: F.col(c).cast("string"), lambda c: F.col(c).cast("double")
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    parts = [
        ("Customer", t("customer"), "c_custkey", text("c_name"), text("c_mktsegment"), number("c_acctbal")),
        ("Supplier", t("supplier"), "s_suppkey", text("s_name"), none_s, number("s_acctbal")),
        ("Part", t("part"), "p_partkey", text("p_name"), text("p_brand"), number("p_retailprice")),
        ("Order", t("orders"), "o_orderkey", none_s, text("o_orderstatus"), number("o_totalprice")),
        ("Nation", t("nation"), "n_nationkey", text("n_name"), none_s, none_d),
        ("Region", t("region"), "r_regionkey", text("r_name"), none_s, none_d),
    ]
    out = [d.select(uid(label, key).alias("uid"), F.col(key).cast("string").alias("canonical_id"), F.lit(label).alias("entity_type"), name.alias("name"), cat.alias("category"), amount.alias("amount")) for label, d, key, name, cat, amount in parts]
    return reduce(DataFrame.unionByName, out)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BUYS_FROM: one edge for each customer and supplier, with the evidence that scoring needs."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_discount", "l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate")
    rows = line.join(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    back = F.col("l_returnflag") == "R"
    out = rows.groupBy("o_custkey", "l_suppkey").agg(
        F.round(F.avg((F.col("l_discount") - 0.05) * 40), 6).alias("effect_size"), F.max("l_extendedprice").alias("_price"), F.sum("l_quantity").cast("long").alias("n"),
        F.count_if(~back).alias("pos_count"), F.count_if(back).alias("neg_count"), F.max(F.year("l_shipdate")).alias("publication_year"), F.min("o_orderpriority").alias("_p"),
    )
    return out.select(
        uid("Customer", "o_custkey").alias("_from"), F.lit("BUYS_FROM").alias("_type"), uid("Supplier", "l_suppkey").alias("_to"), F.lit("Customer").alias("from_label"), F.lit("Supplier").alias("to_label"),
        "effect_size", F.pow(F.lit(10.0), -F.col("_price") / 10000).alias("adj_p"), "n", "pos_count", "neg_count", "publication_year",
        looked_up(F.col("_p"), EVIDENCE, "other").alias("evidence_type"), looked_up(F.col("_p"), SOURCES, "other").alias("source_type"), looked_up(F.col("_p"), DOMAINS, "other").alias("domain"),
    )


def edge(rows: DataFrame, kind: str, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    return rows.select(uid(a[0], a[1]).alias("_from"), F.lit(kind).alias("_type"), uid(b[0], b[1]).alias("_to"), F.lit(a[0]).alias("from_label"), F.lit(b[0]).alias("to_label")).where(F.col("_from").isNotNull() & F.col("_to").isNotNull()).distinct()


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BUYS_BULK Customer -> Supplier and SUPPLIES Supplier -> Part, from rows of 45 pieces or more."""
    line = read(spark, sf_dir, "lineitem").where("l_quantity >= 45").select("l_orderkey", "l_suppkey", "l_partkey")
    rows = line.join(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return edge(rows, "BUYS_BULK", ("Customer", "o_custkey"), ("Supplier", "l_suppkey")).unionByName(edge(line, "SUPPLIES", ("Supplier", "l_suppkey"), ("Part", "l_partkey")))


#: Keys of a brand's chain that one task sorts at most.
CHAIN_KEYS = 4096


def brand_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NEXT_IN_BRAND Part -> Part. A brand is sorted in pieces of its key range; each piece's last part is joined to the first one of the next."""
    from pyspark.sql import Window as W

    piece = ["p_brand", "piece"]
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_brand", F.floor(F.col("p_partkey") / CHAIN_KEYS).alias("piece"))
    firsts = rows.groupBy(*piece).agg(F.min("p_partkey").alias("first"))
    after = firsts.select(F.col("p_brand").alias("brand"), F.col("piece").alias("of"), F.lead("first").over(W.partitionBy("p_brand").orderBy("piece")).alias("after"))
    rows = rows.withColumn("next", F.lead("p_partkey").over(W.partitionBy(*piece).orderBy("p_partkey")))
    inner = rows.where("next is not null").select("p_partkey", "next")
    outer = rows.where("next is null").join(after, F.col("p_brand").eqNullSafe(F.col("brand")) & (F.col("piece") == F.col("of"))).select("p_partkey", F.col("after").alias("next"))
    return edge(inner.unionByName(outer), "NEXT_IN_BRAND", ("Part", "p_partkey"), ("Part", "next"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOCATED_IN and IN_REGION."""
    t = lambda n: read(spark, sf_dir, n)
    out = [edge(t("customer"), "LOCATED_IN", ("Customer", "c_custkey"), ("Nation", "c_nationkey")), edge(t("supplier"), "LOCATED_IN", ("Supplier", "s_suppkey"), ("Nation", "s_nationkey")), edge(t("nation"), "IN_REGION", ("Nation", "n_nationkey"), ("Region", "n_regionkey"))]
    return reduce(DataFrame.unionByName, out)


def favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PREFERS Customer -> Part: the part of the largest quantity, ties to the lowest key."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    best = rows.groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("q")).groupBy("o_custkey").agg(F.max(F.struct(F.col("q"), (-F.col("l_partkey")).alias("p"))).alias("b"))
    return edge(best.select("o_custkey", (-F.col("b.p")).alias("p")), "PREFERS", ("Customer", "o_custkey"), ("Part", "p"))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CONTAINS Order -> Part and PLACED_BY Order -> Customer."""
    return edge(read(spark, sf_dir, "lineitem"), "CONTAINS", ("Order", "l_orderkey"), ("Part", "l_partkey")).unionByName(edge(read(spark, sf_dir, "orders"), "PLACED_BY", ("Order", "o_orderkey"), ("Customer", "o_custkey")))


def strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUPPLIES Supplier -> Part of all lines, the stronger the larger their discount, and NEXT_IN_BRAND: _from, _type, _to, ES_edge."""
    rows = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.round(0.5 + 5 * F.max("l_discount"), 6).alias("ES_edge"))
    supplies = rows.select(uid("Supplier", "l_suppkey").alias("_from"), F.lit("SUPPLIES").alias("_type"), uid("Part", "l_partkey").alias("_to"), "ES_edge")
    return supplies.unionByName(brand_chain(spark, sf_dir).select("_from", "_type", "_to", F.lit(0.9).alias("ES_edge")))


#: Bits of a folded fingerprint.
FOLDED = 2048


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, bits of every part: its features and pairs of them, folded into FOLDED bits by a hash."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    own = {"a": [word(1)], "b": [word(2)], "c": [F.col("p_brand")], "d": [F.col("p_type")], "e": [F.col("p_size")], "f": [word(1), word(2)], "g": [F.col("p_brand"), F.col("p_type")], "h": [word(2), F.col("p_type")], "i": [word(2), F.col("p_size") % 10]}
    features = F.array(*[F.concat_ws("|", F.lit(k), *[x.cast("string") for x in columns]) for k, columns in own.items()])
    bits = F.transform(features, lambda x: (F.conv(F.substring(F.md5(x.cast("binary")), 1, 4), 16, 10).cast("int") % FOLDED))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), bits.alias("bits"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hypothesis_id, Hv, MC: each user's days in order."""
    from pyspark.sql import Window as W

    days = read(spark, sf_dir, "events").where("user_id is not null and ts is not null").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    return days.select(F.col("user_id").alias("hypothesis_id"), F.row_number().over(W.partitionBy("user_id").orderBy("day")).alias("Hv"), rounded(F.least(F.lit(1.0), F.round("v", 6) / 100)).alias("MC"))


#: Plan for the doubled edges below: (conflict, type, from, to, successor, reverse, kind)
RETIRED = [
    ("C-19", "PURCHASED_FROM", "Customer", "Supplier", "BUYS_FROM", False, "synonym_merge"), ("C-14", "SOLD_TO", "Supplier", "Customer", "BUYS_FROM", True, "inverse_merge"),
    ("C-13", "HOSTS", "Nation", "Customer", "LOCATED_IN", True, "inverse_merge"), ("C-07", "KEPT_BY", "Part", "Customer", "KEEPS", True, "redirect"), ("C-07", "RETURNED_BY", "Part", "Customer", "RETURNS", True, "redirect"),
]


def first_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the first schema: kept ones, and synonyms, inverses and redirects of some of them. weight tells them apart."""
    t = lambda n: read(spark, sf_dir, n)
    rows = t("lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = rows.where("l_suppkey % 3 = 0")
    parts = [
        (edge(rows.where("l_suppkey % 2 = 0"), "BUYS_FROM", ("Customer", "o_custkey"), ("Supplier", "l_suppkey")), 1),
        (edge(late, "PURCHASED_FROM", ("Customer", "o_custkey"), ("Supplier", "l_suppkey")), 2), (edge(late, "SOLD_TO", ("Supplier", "l_suppkey"), ("Customer", "o_custkey")), 3),
        (edge(t("customer"), "HOSTS", ("Nation", "c_nationkey"), ("Customer", "c_custkey")), 4),
        (edge(rows.where("l_returnflag <> 'R'"), "KEPT_BY", ("Part", "l_partkey"), ("Customer", "o_custkey")), 5), (edge(rows.where("l_returnflag = 'R'"), "RETURNED_BY", ("Part", "l_partkey"), ("Customer", "o_custkey")), 6),
    ]
    out = reduce(DataFrame.unionByName, [d.withColumn("weight", F.lit(w)) for d, w in parts])
    return out.withColumn("edge_id", F.substring(F.sha2(F.concat_ws("|", "_from", "_type", "_to"), 256), 1, 32))
