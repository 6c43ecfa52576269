"""The corpus pipeline (part of the llm subpackage): documents in, packed training sequences out.

1. toxicity: documents that the grammar rejects go.
2. n-gram Jaccard join: one document of each near-duplicate class stays, the one of least id.
3. suffix-array dedup: bytes go that a string of 200 bytes covers which also starts elsewhere; a character that loses a
   byte goes as a whole. Columns stay, n_chars follows the text.
4. best-fit packing: what is left becomes sequences of 4096 tokens.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns the columns of documents, but the last
one, which returns a row for each packed piece. Each stage's result is written as Parquet in the shared folder and read again. Null ids and texts are kept, as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.llm import jaccard, packing, suffix, toxicity
from evgraph.llm.common import shared_path, table
from evgraph.llm.queries import word_vocabulary


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, grammar)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs, threshold=0.8, ngram=5)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    found = suffix.remove_repeated(docs, length=200, carry=tuple(others), as_text=True)
    text = F.when(~F.col("no_text"), F.col("kept"))
    renewed = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[(renewed[c] if c in renewed else F.col(f"c{others.index(c)}")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, word_vocabulary(), digest=True)


STAGES = [("toxicity", clean), ("ngram_jaccard_join", distinct), ("suffix_array_dedup", without_repeats), ("best_fit_packing", packed)]
ORACLE_SQL = None  # no SQL states the learned grammar or the packing; tests compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
