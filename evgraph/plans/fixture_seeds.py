"""Raw JSON responses derived from the star schema, in the shape that the seed parsers read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.plans.fixture_graph import read

NOW = "2002-01-01 00:00:00"


def raw(rows: DataFrame, source: str, url: Column, data: Column) -> DataFrame:
    return rows.select(F.lit(source).alias("source"), url.alias("url"), F.lit(NOW).cast("timestamp").alias("retrieved_at"), F.to_json(data).alias("data"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct lines, for (order, line number) is no key."""
    c = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return read(spark, sf_dir, "lineitem").select(*c).distinct()


def null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def target_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each part; its lines are its associations, drugs and homologues."""
    n, f = F.col("l_linenumber"), F.col("l_returnflag")
    s = lambda **k: F.struct(*[v.alias(x) for x, v in k.items()])
    supplier = F.concat(F.lit("MONDO_"), F.col("l_suppkey").cast("string"))
    disease = s(score=F.round(F.col("l_discount") * 10, 4), disease=s(id=null_if(n == 7, supplier), name=f, therapeuticAreas=F.array(s(name=f), s(name=F.lit(None).cast("string")))), datatypeScores=F.array(s(id=F.lit("genetic_association"), score=F.round(F.col("l_tax") * 10, 4)), s(id=F.lit("literature"), score=F.round(F.col("l_discount") * 8, 4)), s(id=F.lit(None).cast("string"), score=F.lit(0.1))))
    action = F.when(f == "R", "INHIBITOR").when(f == "A", " agonist ").otherwise("OTHER")
    mechanisms = F.when(n == 5, F.array().cast("array<struct<mechanismOfAction:string,actionType:string>>")).otherwise(F.array(s(mechanismOfAction=F.lit("m"), actionType=action)))
    stage = F.when(n == 1, "PHASE_1").when(n == 2, "approved")
    drug = s(maxClinicalStage=F.lit("PHASE_3"), drug=s(id=null_if(n == 6, F.concat(F.lit("D"), F.col("l_orderkey").cast("string"))), drugType=f, maximumClinicalStage=stage, mechanismsOfAction=s(rows=mechanisms)), diseases=F.array(s(disease=s(id=F.concat(F.lit("EFO_"), F.col("l_suppkey").cast("string")), name=f)), s(disease=F.lit(None).cast("struct<id:string,name:string>"))))
    homologue = s(targetGeneSymbol=null_if(n == 4, F.concat(F.lit("g"), F.col("l_suppkey").cast("string"))), speciesId=f, homologyType=F.when(F.col("l_linestatus") == "O", "ortholog_one2one").otherwise("within_species_paralog"), queryPercentageIdentity=F.col("l_quantity"))
    g = lines(spark, sf_dir).groupBy("l_partkey").agg(F.collect_list(disease).alias("a"), F.collect_list(drug).alias("d"), F.collect_list(homologue).alias("h"))
    body = s(data=s(target=s(id=F.concat(F.lit("E"), F.col("l_partkey").cast("string")), approvedSymbol=F.concat(F.lit("P"), F.col("l_partkey").cast("string")), associatedDiseases=s(rows=F.col("a")), drugAndClinicalCandidates=s(rows=F.col("d")), homologues=F.col("h"))))
    return raw(g, "targets", F.concat(F.lit("t/"), F.col("l_partkey").cast("string")), body)


def network_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each part: pairs with its suppliers' numbers, in line order."""
    e = F.struct(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("preferredName_A"), null_if(F.col("l_linenumber") == 7, F.concat(F.lit("P"), (F.col("l_suppkey") * 3).cast("string"))).alias("preferredName_B"), F.round(F.col("l_discount") * 10, 4).alias("score"), F.round(F.col("l_tax") * 5, 4).alias("escore"), F.round(F.col("l_discount") * 3, 4).alias("dscore"), F.lit(0.1).alias("tscore"))
    key = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_discount", "l_tax", "l_quantity")
    g = lines(spark, sf_dir).groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), e.alias("e")))).alias("r"))
    return raw(g, "network", F.concat(F.lit("n/"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")), F.transform("r", lambda x: x["e"]))


def variant_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each page of 1,000 customer keys of a nation, its customers as variants."""
    k = F.col("c_custkey")
    page = F.floor(k / 1000).alias("page")
    loc = F.when(k % 7 == 0, F.array().cast("array<struct<chromosomeName:string,chromosomePosition:bigint>>")).otherwise(F.array(F.struct(F.col("c_nationkey").cast("string").alias("chromosomeName"), (k * 100).alias("chromosomePosition"))))
    v = F.struct(null_if(k % 10 == 0, F.concat(F.lit("rs"), k.cast("string"))).alias("rsId"), F.col("c_mktsegment").alias("functionalClass"), loc.alias("locations"))
    g = read(spark, sf_dir, "customer").groupBy("c_nationkey", page).agg(F.collect_list(v).alias("v"))
    return raw(g, "variants", F.concat_ws("/", F.lit("v"), F.col("c_nationkey").cast("string"), F.col("page").cast("string")), F.struct(F.struct(F.col("v").alias("singleNucleotidePolymorphisms")).alias("_embedded")))


def association_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each customer, its orders as associations in key order."""
    o = F.struct("o_orderkey", F.struct(F.round(F.col("o_totalprice") / 1e6, 6).alias("pvalue"), F.when(F.col("o_orderstatus") == "F", F.round(F.col("o_totalprice") / 1e5, 4)).alias("betaNum"), F.col("o_orderstatus").alias("riskFrequency"), F.array(F.struct(F.concat(F.lit("EFO_"), F.substring("o_orderpriority", 1, 1)).alias("shortForm"), F.col("o_orderpriority").alias("trait")), F.struct(F.lit("EFO_9").alias("shortForm"), F.lit(None).cast("string").alias("trait"))).alias("efoTraits")).alias("a"))
    g = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(o)).alias("a"))
    return raw(g, "associations", F.concat(F.lit("v/rs"), F.col("o_custkey").cast("string"), F.lit("/associations")), F.struct(F.struct(F.transform("a", lambda x: x["a"]).alias("associations")).alias("_embedded")))


def expression_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each part, each of its suppliers as a tissue."""
    g = lines(spark, sf_dir).groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("q"))
    x = F.struct(F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("tissueSiteDetailId"), F.concat(F.lit("UBERON:"), F.col("l_suppkey").cast("string")).alias("ontologyId"), F.when(F.col("q") % 7 != 0, F.col("q") / 10).alias("median"), F.lit("TPM").alias("unit"))
    g = g.groupBy("l_partkey").agg(F.collect_list(x).alias("data"))
    return raw(g, "expression", F.concat(F.lit("x/P"), F.col("l_partkey").cast("string")), F.struct("data"))


def term_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each supplier; its own number is its cross reference in two databases."""
    k = F.col("s_suppkey")
    x = lambda d, i: F.struct(F.lit(d).cast("string").alias("database"), i.cast("string").alias("id"))
    t = F.struct(null_if(k % 11 == 0, F.concat(F.lit("MONDO:"), k.cast("string"))).alias("obo_id"), F.col("s_name").alias("label"), F.array(F.col("s_name")).alias("description"), F.array(x("omim", k), x("OMIM", k + 1), x("Doid", k), x(None, k)).alias("obo_xref"))
    return raw(read(spark, sf_dir, "supplier"), "terms", F.concat(F.lit("o/"), k.cast("string")), F.struct(F.struct(F.array(t).alias("terms")).alias("_embedded")))


def annotation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each supplier: its parts as phenotypes, by return flag in one nesting for even keys, in the other for odd ones."""
    g = lines(spark, sf_dir).groupBy("l_suppkey", "l_returnflag").agg(F.array_sort(F.collect_set(F.struct(F.concat(F.lit("HP:"), F.col("l_partkey").cast("string")).alias("id"), F.lit("x").alias("name")))).alias("p"))
    g = g.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_returnflag").alias("c"), "p"))).alias("c"))
    even = F.to_json(F.struct(F.map_from_arrays(F.transform("c", lambda x: x["c"]), F.transform("c", lambda x: x["p"])).alias("categories")))
    odd = F.to_json(F.struct(F.transform("c", lambda x: F.struct(x["c"].alias("catLabel"), x["p"].alias("terms"))).alias("categories"), F.array(F.struct(F.lit("HP:plain").alias("id"), F.lit("y").alias("name"))).alias("phenotypes")))
    return g.select(F.lit("annotations").alias("source"), F.concat(F.lit("a/"), F.col("l_suppkey").cast("string")).alias("url"), F.lit(NOW).cast("timestamp").alias("retrieved_at"), F.when(F.col("l_suppkey") % 2 == 0, even).otherwise(odd).alias("data"))


def publication_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response for each customer, its orders as publications."""
    k = F.col("o_orderkey").cast("string")
    a = F.struct(F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderstatus") == "F", " Nature ").when(F.col("o_orderstatus") == "O", "").otherwise("Other").alias("fulljournalname"), F.lit("JAMA").alias("source"), F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "yyyy MMM")).alias("pubdate"), F.array(F.struct(F.lit("pii").alias("idtype"), k.alias("value")), F.struct(F.lit("doi").alias("idtype"), F.concat(F.lit("10/"), k).alias("value"))).alias("articleids"))
    g = read(spark, sf_dir, "orders").select("o_custkey", k.alias("k"), a.alias("a")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("k", "a"))).alias("result"))
    return raw(g, "publications", F.concat(F.lit("p/"), F.col("o_custkey").cast("string")), F.struct("result"))
