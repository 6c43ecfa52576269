"""One query for each operator, over whole tables."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.llm import sql
from evgraph.llm.common import table


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.substring import remove_repeated_windows

    out = remove_repeated_windows(table(spark, sf_dir, "documents"), window=13)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(0, len(w) - 12)) AS place, w FROM words WHERE len(w) >= 13
), hashed AS (
  SELECT doc_id, place, md5(array_to_string(list_slice(w, place + 1, place + 13), ' ')) AS h FROM windows
), marked AS (
  SELECT doc_id, place, min(doc_id) OVER (PARTITION BY h) < doc_id AS gone FROM hashed
), gone AS (
  SELECT DISTINCT doc_id, place + unnest(range(0, 13)) AS place FROM marked WHERE gone
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM words
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.place) AS kept, count(*) AS n FROM each e ANTI JOIN gone USING (doc_id, place) GROUP BY 1
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.jaccard import join

    return join(table(spark, sf_dir, "documents"), threshold=0.8, ngram=5).select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), word_vocabulary(), digest=True)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.suffix import remove_repeated

    out = remove_repeated(table(spark, sf_dir, "documents"), length=200)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.knn import search

    return search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(50)) == 0, k=5, scale=256.0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM k
"""


def op7_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.toxicity import held_out, learn, score

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    out = score(docs, grammar)
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.bpe import encode

    def digests(ids, rows, vocab):
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return pa.record_batch(
            [ids, pa.array([len(r) for r in rows], pa.int64()), pa.array([sha(r.astype("<u4").tobytes()) for r in rows], pa.string()), pa.array([sha(vocab.decode(r.tolist()).encode()) for r in rows], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return encode(table(spark, sf_dir, "documents"), word_vocabulary(), then=digests, schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.lm import score

    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.spotsigs import compare_with_next

    return compare_with_next(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.variants import group

    return group(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evgraph.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def spotsigs_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of operator 10: the class of each document's signature among all."""
    from evgraph.llm.spotsigs import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_voronoi_knn": op4_voronoi_knn,
    "op5_suffix_array": op5_suffix_array,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_toxicity_grammar": op7_toxicity_grammar,
    "op8_bpe": op8_bpe,
    "op9_cross_entropy_difference": op9_cross_entropy_difference,
    "op10_spotsigs": op10_spotsigs,
    "op11_license_scan": op11_license_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_audit": op13_filter_audit,
    "spotsigs_near_duplicates": spotsigs_near_duplicates,
}
ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op2_ngram_jaccard_join": sql.NGRAM_JACCARD_JOIN, "op4_voronoi_knn": OP4_SQL, "op5_suffix_array": sql.SUFFIX_ARRAY, "op6_warc_revisits": OP6_SQL, "op9_cross_entropy_difference": sql.CROSS_ENTROPY_DIFFERENCE, "op11_license_scan": sql.license_scan(), "op12_spelling_variants": sql.SPELLING_VARIANTS, "op13_filter_audit": sql.FILTER_AUDIT, "spotsigs_near_duplicates": sql.spotsigs_near_duplicates()}
