"""Normalisation of raw JSON responses into rows and edges. Input: raw(source, url, retrieved_at, data STRING); every output row
keeps _url and _retrieved_at. Missing or malformed records give no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.functions.scoring import looked_up
from evgraph.operators.upsert import first_wins
from evgraph.schema import ACTION_DIRECTION, CHANNEL_TYPE, HIGH_AUTHORITY_JOURNALS, STAGE_PHASE

TARGET = """data STRUCT<target: STRUCT<id: STRING, approvedSymbol: STRING, biotype: STRING,
  associatedDiseases: STRUCT<rows: ARRAY<STRUCT<score: DOUBLE, disease: STRUCT<id: STRING, name: STRING, therapeuticAreas: ARRAY<STRUCT<name: STRING>>>, datatypeScores: ARRAY<STRUCT<id: STRING, score: DOUBLE>>>>>,
  drugAndClinicalCandidates: STRUCT<rows: ARRAY<STRUCT<maxClinicalStage: STRING, drug: STRUCT<id: STRING, name: STRING, drugType: STRING, maximumClinicalStage: STRING,
    mechanismsOfAction: STRUCT<rows: ARRAY<STRUCT<mechanismOfAction: STRING, actionType: STRING>>>>, diseases: ARRAY<STRUCT<disease: STRUCT<id: STRING, name: STRING>>>>>>,
  homologues: ARRAY<STRUCT<targetGeneId: STRING, targetGeneSymbol: STRING, speciesId: STRING, speciesName: STRING, homologyType: STRING, queryPercentageIdentity: DOUBLE, targetPercentageIdentity: DOUBLE, isHighConfidence: BOOLEAN>>>>"""
NETWORK = "ARRAY<STRUCT<preferredName_A: STRING, preferredName_B: STRING, stringId_A: STRING, stringId_B: STRING, score: DOUBLE, escore: DOUBLE, dscore: DOUBLE, tscore: DOUBLE, ascore: DOUBLE>>"
VARIANTS = "_embedded STRUCT<singleNucleotidePolymorphisms: ARRAY<STRUCT<rsId: STRING, functionalClass: STRING, locations: ARRAY<STRUCT<chromosomeName: STRING, chromosomePosition: BIGINT, region: STRUCT<name: STRING>>>>>>"
ASSOCIATIONS = "_embedded STRUCT<associations: ARRAY<STRUCT<pvalue: DOUBLE, betaNum: DOUBLE, betaDirection: STRING, orPerCopyNum: DOUBLE, riskFrequency: STRING, efoTraits: ARRAY<STRUCT<shortForm: STRING, trait: STRING>>>>>"
EXPRESSION = "data ARRAY<STRUCT<tissueSiteDetailId: STRING, ontologyId: STRING, median: DOUBLE, unit: STRING>>"
TERMS = "_embedded STRUCT<terms: ARRAY<STRUCT<obo_id: STRING, label: STRING, description: ARRAY<STRING>, iri: STRING, is_obsolete: BOOLEAN, synonyms: ARRAY<STRING>, obo_xref: ARRAY<STRUCT<database: STRING, id: STRING>>>>>"
PHENOTYPE = "STRUCT<id: STRING, name: STRING, onset: STRING, frequency: STRING>"
ANNOTATION_MAP = f"categories MAP<STRING, ARRAY<{PHENOTYPE}>>, phenotypes ARRAY<{PHENOTYPE}>"
ANNOTATION_LIST = f"categories ARRAY<STRUCT<catLabel: STRING, name: STRING, terms: ARRAY<{PHENOTYPE}>>>, phenotypes ARRAY<{PHENOTYPE}>"
SUMMARY = "result MAP<STRING, STRING>"
ARTICLE = "title STRING, fulljournalname STRING, source STRING, issn STRING, pubdate STRING, articleids ARRAY<STRUCT<idtype: STRING, value: STRING>>"


def parsed(raw: DataFrame, schema: str) -> DataFrame:
    """r, _url, _retrieved_at. Filters on r stay above the explode; over a plain column they would be pushed down with a copy of the parser each, and every
    response be parsed once for each of them."""
    return raw.select(F.explode(F.array(F.from_json("data", schema))).alias("r"), F.col("url").alias("_url"), F.col("retrieved_at").alias("_retrieved_at"))


def curie(x: Column) -> Column:
    """The first underscore becomes a colon where there is no colon yet."""
    return F.when(x.contains(":"), x).otherwise(F.regexp_replace(x, "^([^_]*)_", "$1:"))


def action_direction(x: Column) -> Column:
    return looked_up(F.upper(F.trim(x)), ACTION_DIRECTION, 0)


def last_wins_map(entries: Column) -> Column:
    """Map of (id, score) entries; without null ids, later ones win."""
    whole = F.filter(entries, lambda x: x["id"].isNotNull())
    return F.map_from_entries(F.filter(whole, lambda x, i: ~F.exists(F.slice(whole, i + 2, F.greatest(F.size(whole) - i - 1, F.lit(0))), lambda y: y["id"] == x["id"])))


def targets(raw: DataFrame) -> DataFrame:
    return parsed(raw, TARGET).select("r.data.target.*", "_url", "_retrieved_at").where(F.col("id").isNotNull())


def target_diseases(raw: DataFrame) -> DataFrame:
    rows = targets(raw).select(F.col("id").alias("ensembl_id"), F.col("approvedSymbol").alias("symbol"), "_url", "_retrieved_at", F.explode("associatedDiseases.rows").alias("x")).where(F.col("x.disease.id").isNotNull())
    scores = F.coalesce(last_wins_map(F.col("x.datatypeScores")), F.create_map().cast("map<string,double>"))
    areas = F.coalesce(F.filter(F.transform("x.disease.therapeuticAreas", lambda a: a["name"]), lambda n: n.isNotNull()), F.array().cast("array<string>"))
    return rows.select("ensembl_id", "symbol", curie(F.col("x.disease.id")).alias("disease_id"), F.col("x.disease.name").alias("name"), F.col("x.score").alias("score"), scores.alias("datatype_scores"), areas.alias("therapeutic_areas"), "_url", "_retrieved_at")


def target_drugs(raw: DataFrame) -> DataFrame:
    rows = targets(raw).select(F.col("id").alias("ensembl_id"), F.col("approvedSymbol").alias("symbol"), "_url", "_retrieved_at", F.explode("drugAndClinicalCandidates.rows").alias("x")).where(F.col("x.drug.id").isNotNull())
    first = F.get(F.col("x.drug.mechanismsOfAction.rows"), 0)
    named = F.filter("x.diseases", lambda d: d["disease"]["id"].isNotNull())
    indications = F.coalesce(F.transform(named, lambda d: F.struct(curie(d["disease"]["id"]).alias("disease_id"), d["disease"]["name"].alias("name"))), F.array().cast("array<struct<disease_id:string,name:string>>"))
    return rows.select(
        "ensembl_id", "symbol", F.col("x.drug.id").alias("drug_id"), F.col("x.drug.name").alias("name"), F.col("x.drug.drugType").alias("drug_type"), F.coalesce("x.drug.maximumClinicalStage", "x.maxClinicalStage").alias("max_clinical_stage"),
        first["mechanismOfAction"].alias("mechanism_of_action"), first["actionType"].alias("action_type"), action_direction(first["actionType"]).alias("direction"), indications.alias("indications"), "_url", "_retrieved_at",
    )


def target_homologues(raw: DataFrame) -> DataFrame:
    rows = targets(raw).select(F.col("id").alias("ensembl_id"), F.col("approvedSymbol").alias("symbol"), "_url", "_retrieved_at", F.explode("homologues").alias("h")).where(F.col("h.targetGeneSymbol").isNotNull() & F.col("h.speciesId").isNotNull())
    h = F.col("h")
    return rows.select("ensembl_id", "symbol", h["targetGeneSymbol"].alias("target_symbol"), h["speciesId"].alias("species_id"), h["homologyType"].alias("homology_type"), F.coalesce(h["homologyType"].contains("ortholog"), F.lit(False)).alias("is_ortholog"), h["queryPercentageIdentity"].alias("query_pct_identity"), F.coalesce(h["isHighConfidence"], F.lit(False)).alias("is_high_confidence"), "_url", "_retrieved_at")


def interactions(raw: DataFrame, least: float = 0.4) -> DataFrame:
    """One row for each unordered pair, the first by url and place."""
    rows = parsed(raw, NETWORK).select("_url", "_retrieved_at", F.posexplode("r").alias("_i", "e"))
    e, zero = F.col("e"), F.lit(0.0)
    out = rows.select(e["preferredName_A"].alias("a"), e["preferredName_B"].alias("b"), F.coalesce(e["score"], zero).alias("score"), F.coalesce(e["escore"], zero).alias("experimental"), F.coalesce(e["dscore"], zero).alias("database"), F.coalesce(e["tscore"], zero).alias("textmining"), F.coalesce(e["ascore"], zero).alias("coexpression"), "_url", "_retrieved_at", "_i")
    out = out.where((F.col("score") >= least) & (F.coalesce("a", F.lit("")) != "") & (F.coalesce("b", F.lit("")) != ""))
    out = out.withColumns({"_lo": F.least("a", "b"), "_hi": F.greatest("a", "b")})
    return first_wins(out, ["_lo", "_hi"], ["_url", "_i"]).drop("_lo", "_hi", "_i")


def variants(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, VARIANTS).select("_url", "_retrieved_at", F.explode("r._embedded.singleNucleotidePolymorphisms").alias("s")).where(F.col("s.rsId").isNotNull())
    loc = F.get(F.col("s.locations"), 0)
    return rows.select(F.col("s.rsId").alias("variant_id"), F.coalesce(loc["chromosomeName"], F.lit("")).alias("chromosome"), loc["chromosomePosition"].alias("base_position"), F.col("s.functionalClass").alias("consequence"), loc["region"]["name"].alias("cytogenetic_region"), "_url", "_retrieved_at")


def associations(raw: DataFrame) -> DataFrame:
    """variant_id is the last part of the url's path before /associations."""
    rows = parsed(raw, ASSOCIATIONS).select("_url", "_retrieved_at", F.posexplode("r._embedded.associations").alias("_i", "a"))
    named = F.filter("a.efoTraits", lambda t: t["trait"].isNotNull())
    traits = F.coalesce(F.transform(named, lambda t: F.struct(F.regexp_replace(F.coalesce(t["shortForm"], F.lit("")), "^([^_]*)_", "$1:").alias("trait_id"), t["trait"].alias("name"))), F.array().cast("array<struct<trait_id:string,name:string>>"))
    return rows.select(F.regexp_extract("_url", "([^/]+)/associations", 1).alias("variant_id"), F.col("a.pvalue").alias("p_value"), F.col("a.betaNum").alias("beta"), F.col("a.riskFrequency").alias("risk_frequency"), traits.alias("traits"), F.col("_i").alias("position"), "_url", "_retrieved_at")


def expression(raw: DataFrame, symbol: Column) -> DataFrame:
    rows = raw.select(symbol.alias("gene_symbol"), F.from_json("data", EXPRESSION).alias("r"), F.col("url").alias("_url"), F.col("retrieved_at").alias("_retrieved_at"))
    rows = rows.select("gene_symbol", "_url", "_retrieved_at", F.explode("r.data").alias("x")).where(F.col("x.median").isNotNull())
    return rows.select("gene_symbol", F.col("x.tissueSiteDetailId").alias("tissue"), F.col("x.ontologyId").alias("tissue_uberon"), F.col("x.median").alias("median_tpm"), F.col("x.unit").alias("unit"), "_url", "_retrieved_at")


def terms(raw: DataFrame) -> DataFrame:
    """The first term of each response, its cross references by upper-cased database, and prefixed ids of one of them."""
    rows = parsed(raw, TERMS).select("_url", "_retrieved_at", F.get(F.col("r._embedded.terms"), 0).alias("t")).where(F.col("t.obo_id").isNotNull())
    rows = rows.select(F.col("t.obo_id").alias("term_id"), F.col("t.label").alias("name"), F.get(F.col("t.description"), 0).alias("definition"), F.coalesce("t.is_obsolete", F.lit(False)).alias("is_obsolete"), F.coalesce("t.synonyms", F.array().cast("array<string>")).alias("synonyms"), F.filter(F.coalesce("t.obo_xref", F.array().cast("array<struct<database:string,id:string>>")), lambda x: x["database"].isNotNull() & x["id"].isNotNull()).alias("x"), "_url", "_retrieved_at")
    names = F.array_distinct(F.transform("x", lambda x: F.upper(x["database"])))
    xrefs = F.map_from_arrays(names, F.transform(names, lambda n: F.transform(F.filter("x", lambda x: F.upper(x["database"]) == n), lambda x: x["id"])))
    omim = F.coalesce(F.transform(F.try_element_at(xrefs, F.lit("OMIM")), lambda i: F.concat(F.lit("OMIM:"), i)), F.array().cast("array<string>"))
    return rows.select("term_id", "name", "definition", "is_obsolete", "synonyms", xrefs.alias("xrefs"), omim.alias("omim_ids"), "_url", "_retrieved_at")


def parents(raw: DataFrame) -> DataFrame:
    """(parent) ids of a parents response."""
    return parsed(raw, TERMS).select("_url", "_retrieved_at", F.explode("r._embedded.terms").alias("t")).select(F.col("t.obo_id").alias("parent"), "_url", "_retrieved_at").where(F.col("parent").isNotNull())


def annotations(raw: DataFrame, source_disease: Column) -> DataFrame:
    """Phenotypes of a disease from category lists (either nesting) and the plain list, once each, the first wins."""
    base = raw.select(source_disease.alias("source_disease"), F.col("url").alias("_url"), F.col("retrieved_at").alias("_retrieved_at"), F.from_json("data", ANNOTATION_MAP).alias("m"), F.from_json("data", ANNOTATION_LIST).alias("l"))
    keep = ["source_disease", "_url", "_retrieved_at"]
    by_map = base.select(*keep, F.posexplode(F.map_entries("m.categories")).alias("_c", "c")).select(*keep, "_c", F.col("c.key").alias("category"), F.posexplode("c.value").alias("_i", "p"))
    by_list = base.select(*keep, F.posexplode("l.categories").alias("_c", "c")).select(*keep, "_c", F.coalesce("c.catLabel", "c.name").alias("category"), F.posexplode("c.terms").alias("_i", "p"))
    plain = base.select(*keep, F.lit(1 << 30).alias("_c"), F.lit(None).cast("string").alias("category"), F.posexplode(F.coalesce("m.phenotypes", "l.phenotypes")).alias("_i", "p"))
    rows = by_map.unionByName(by_list).unionByName(plain).where(F.col("p.id").isNotNull())
    out = rows.select(*keep, F.col("p.id").alias("phenotype_id"), F.col("p.name").alias("name"), "category", F.col("p.onset").alias("onset"), F.col("p.frequency").alias("frequency"), "_c", "_i")
    return first_wins(out, ["source_disease", "phenotype_id"], ["_c", "_i"])


def merge_annotations(links: DataFrame, found: DataFrame, most: int = 3) -> DataFrame:
    """links(disease_id, source_disease, position): up to `most` sources of a disease, merged, the first source wins."""
    from pyspark.sql import Window as W

    chosen = links.withColumn("_n", F.row_number().over(W.partitionBy("disease_id").orderBy("position"))).where(F.col("_n") <= most)
    both = chosen.select("disease_id", "source_disease", "_n").join(found, "source_disease")
    return first_wins(both, ["disease_id", "phenotype_id"], ["_n", "_c", "_i"]).drop("_n", "_c", "_i")


def publications(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, SUMMARY).select("_url", "_retrieved_at", F.explode("r.result").alias("pmid", "x")).where(F.col("pmid") != "uids").select("pmid", F.from_json("x", ARTICLE).alias("a"), "_url", "_retrieved_at")
    journal = F.trim(F.coalesce(F.nullif(F.col("a.fulljournalname"), F.lit("")), F.col("a.source"), F.lit("")))
    year = F.when(F.col("a.pubdate").rlike("^[0-9]{4}"), F.substring("a.pubdate", 1, 4).cast("int"))
    doi = F.get(F.filter("a.articleids", lambda x: x["idtype"] == "doi"), 0)["value"]
    return rows.select(F.concat(F.lit("PMID:"), "pmid").alias("publication_id"), F.col("a.title").alias("title"), journal.alias("journal"), F.nullif(F.col("a.issn"), F.lit("")).alias("issn"), year.alias("publication_year"), doi.alias("doi"), F.lit("peer_reviewed").alias("source_type"), F.lower(journal).isin(HIGH_AUTHORITY_JOURNALS).alias("is_high_authority"), "_url", "_retrieved_at")


def merge_genes(first: DataFrame, second: DataFrame, third: DataFrame, names: tuple[str, str, str] = ("hgnc", "ensembl", "uniprotkb")) -> DataFrame:
    """Left joins by symbol: ensembl_id from the first source before the second, chromosome and biotype the other way round; the
    contributing sources in merge order."""
    a, b = first.alias("a"), second.select("symbol", "ensembl_id", "chromosome", "biotype").withColumn("_b", F.lit(True)).alias("b")
    c = third.select("symbol", "protein_id").withColumn("_c", F.lit(True)).alias("c")
    rows = a.join(b, F.col("a.symbol") == F.col("b.symbol"), "left").join(c, F.col("a.symbol") == F.col("c.symbol"), "left")
    ids = F.filter(F.array(F.lit(names[0]), F.when(F.col("_b"), F.lit(names[1])), F.when(F.col("_c"), F.lit(names[2]))), lambda x: x.isNotNull())
    return rows.select(F.col("a.symbol").alias("symbol"), F.coalesce("a.ensembl_id", "b.ensembl_id").alias("ensembl_id"), F.coalesce("b.chromosome", "a.chromosome").alias("chromosome"), F.coalesce("b.biotype", "a.biotype").alias("biotype"), "protein_id", ids.alias("source_ids"))


def collapse_proteins(rows: DataFrame, order: str, most_synonyms: int = 15) -> DataFrame:
    """One row for each accession: its first record, all its symbols in order, and the others among its synonyms."""
    g = rows.where(F.col("protein_id").isNotNull()).groupBy("protein_id").agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.col("symbol"), F.col("name"), F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms")))).alias("g"))
    symbols, first = F.transform("g", lambda x: x["symbol"]), F.get("g", 0)
    return g.select("protein_id", F.coalesce(first["name"], F.col("protein_id")).alias("name"), first["symbol"].alias("gene_symbol"), symbols.alias("encoded_by_symbols"), F.slice(F.concat(first["synonyms"], F.slice(symbols, 2, F.greatest(F.size(symbols), F.lit(1)))), 1, most_synonyms).alias("synonyms"))


def variant_statistics(found: DataFrame, stats: DataFrame) -> DataFrame:
    """Variants with the figures of their first association."""
    first = first_wins(stats, ["variant_id"], ["_url", "position"]).select("variant_id", F.col("p_value").alias("p_raw"), F.col("beta").alias("effect_weight"), F.col("risk_frequency").alias("allele_frequency"))
    return found.join(first, "variant_id", "left")


def clinical_phase(stage: Column) -> Column:
    """struct(max_phase, approved)."""
    phase = looked_up(F.upper(stage), STAGE_PHASE, 0)
    return F.struct(phase.alias("max_phase"), (phase >= 4).alias("approved"))


# ---------------------------------------------------------------- edges


def _u(label: str, c) -> Column:
    return F.concat(F.lit(f"{label}:"), F.col(c) if isinstance(c, str) else c)


def channel_edges(diseases: DataFrame) -> DataFrame:
    """Up to three typed edges from each map of channel scores."""
    rows = diseases.select("symbol", "disease_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.explode("datatype_scores").alias("channel", "ch")).where(F.col("channel").isin(*CHANNEL_TYPE) & F.col("ch").isNotNull())
    strong = F.col("ch") > 0.5
    return rows.select(_u("Gene", "symbol").alias("_from"), looked_up(F.col("channel"), CHANNEL_TYPE, "").alias("_type"), _u("Disease", "disease_id").alias("_to"), F.when(strong, "curated_db").otherwise("text_mined").alias("evidence_type"), F.when(strong, "curated_ontology").otherwise("peer_reviewed").alias("source_type"), F.round(2 * F.col("ch"), 4).alias("effect_size"), F.pow(F.lit(10.0), -F.greatest(F.lit(1.5), 20 * F.col("ch"))).alias("adj_p"), F.floor(200 + F.col("score") * 4000).cast("long").alias("n"))


def drug_edges(drugs: DataFrame) -> DataFrame:
    """Signed edges to the target and treatment edges to each indication."""
    d = F.col("direction")
    kind = F.when(d < 0, "PHARMACOLOGICALLY_INHIBITS").when(d > 0, "PHARMACOLOGICALLY_ACTIVATES").otherwise("EXERTS_OFF_TARGET_EFFECT")
    signed = drugs.select(_u("Drug", "drug_id").alias("_from"), kind.alias("_type"), _u("Protein", "symbol").alias("_to"), d.alias("direction"), F.lit("experimental_validation").alias("evidence_type"), F.lit("clinical_registry").alias("source_type"))
    treats = drugs.select("drug_id", F.explode("indications").alias("i")).select(_u("Drug", "drug_id").alias("_from"), F.lit("CLINICALLY_TREATS").alias("_type"), _u("Disease", "i.disease_id").alias("_to"), F.lit(-1).alias("direction"), F.lit("replication").alias("evidence_type"), F.lit("clinical_registry").alias("source_type"))
    return signed.unionByName(treats)


def conservation_edges(homologues: DataFrame, species: DataFrame) -> DataFrame:
    """species(species_id): those that exist."""
    rows = homologues.where("is_ortholog").join(species.select("species_id"), "species_id", "left_semi")
    pct = F.when(F.coalesce("query_pct_identity", F.lit(0.0)) == 0, 50.0).otherwise(F.col("query_pct_identity"))
    return rows.select(_u("Gene", "symbol").alias("_from"), F.lit("CONSERVED_IN").alias("_type"), _u("Species", "species_id").alias("_to"), F.round(pct / 50, 4).alias("effect_size"), F.lit(1e-8).alias("adj_p"), F.lit(1).cast("long").alias("n"))


def interaction_edges(pairs: DataFrame) -> DataFrame:
    """Observed or predicted, as gene pair and as protein pair."""
    seen = F.greatest("experimental", "database") > 0.3
    base = pairs.select("a", "b", F.when(seen, "high_throughput").otherwise("text_mined").alias("evidence_type"), F.round(F.col("score") * 2, 4).alias("effect_size"), F.pow(F.lit(10.0), -F.greatest(F.lit(1.5), F.col("score") * 12)).alias("adj_p"), F.when(seen, "INTERACTS_WITH").otherwise("PREDICTED_TO_INTERACT_WITH").alias("kind"))
    genes = base.select(_u("Gene", "a").alias("_from"), F.col("kind").alias("_type"), _u("Gene", "b").alias("_to"), "evidence_type", "effect_size", "adj_p")
    return genes.unionByName(base.select(_u("Protein", "a").alias("_from"), F.lit("PROTEIN_INTERACTS_WITH").alias("_type"), _u("Protein", "b").alias("_to"), "evidence_type", "effect_size", "adj_p"))


def membership_edges(members: DataFrame) -> DataFrame:
    """members(gene_symbol, protein_id, pathway_id), each edge once: made distinct before the edges' strings are built, for these are several times as large."""
    def edges(label: str, kind: str, member: str) -> DataFrame:
        pairs = members.where(F.col(member).isNotNull()).select(member, "pathway_id").distinct()
        return pairs.select(_u(label, member).alias("_from"), F.lit(kind).alias("_type"), _u("Pathway", "pathway_id").alias("_to"))

    return edges("Gene", "PARTICIPATES_IN", "gene_symbol").unionByName(edges("Protein", "PROTEIN_PARTICIPATES_IN", "protein_id"))


def expression_edges(rows: DataFrame, least: float = 1.0) -> DataFrame:
    kept = rows.where((F.col("median_tpm") >= least) & F.col("tissue_uberon").isNotNull() & F.col("gene_symbol").isNotNull())
    return kept.select(_u("Gene", "gene_symbol").alias("_from"), F.lit("EXPRESSED_IN").alias("_type"), _u("Tissue", "tissue_uberon").alias("_to"), F.round(F.least(F.lit(2.0), F.col("median_tpm") / 30), 4).alias("effect_size"), F.lit(1e-6).alias("adj_p"), F.lit(300).cast("long").alias("n"))


def variant_edges(links: DataFrame, stats: DataFrame) -> DataFrame:
    """Locus and QTL edges of links(variant_id, gene_symbol), and trait edges with their own figures."""
    locus = [links.select(_u("Variant", "variant_id").alias("_from"), F.lit(k).alias("_type"), _u("Gene", "gene_symbol").alias("_to"), F.lit(None).cast("double").alias("effect_size"), F.lit(None).cast("double").alias("adj_p")) for k in ("MAPS_TO_LOCUS", "eQTL_MODULATES")]
    traits = stats.select("variant_id", "beta", "p_value", F.explode("traits").alias("t")).where(F.col("t.trait_id") != "")
    trait = traits.select(_u("Variant", "variant_id").alias("_from"), F.lit("GWAS_ASSOCIATED_WITH").alias("_type"), _u("Trait", "t.trait_id").alias("_to"), F.when(F.col("beta") != 0, F.col("beta")).alias("effect_size"), F.coalesce(F.when(F.col("p_value") != 0, F.col("p_value")), F.lit(1e-8)).alias("adj_p"))
    return locus[0].unionByName(locus[1]).unionByName(trait)


def ontology_edges(pairs: DataFrame, diseases: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Parent to child terms (pairs: child, parent), disease to its term, phenotype to disease."""
    tree = pairs.select(_u("OntologyTerm", "parent").alias("_from"), F.lit("ONTOLOGICALLY_INCLUDES").alias("_type"), _u("OntologyTerm", "child").alias("_to"))
    own = diseases.select(_u("Disease", "disease_id").alias("_from"), F.lit("STANDARDIZED_BY_ONTOLOGY").alias("_type"), _u("OntologyTerm", "disease_id").alias("_to"))
    seen = phenotypes.select(_u("Phenotype", "phenotype_id").alias("_from"), F.lit("DISTINGUISHES_COHORT").alias("_type"), _u("Disease", "disease_id").alias("_to"))
    return tree.unionByName(own).unionByName(seen).where("_from <> _to").distinct()
