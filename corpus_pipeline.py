"""A training-data pipeline over `documents`: quality, near-duplicates, benchmark passages, mixing, token store.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.llm import decontaminate, mixing, near_duplicates, quality, token_store
from tablescout.llm.common import scratch, table
from tablescout.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from those of `docs` with labels.

    A document without doc_id is scored like others.
    """
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), keep=["text", "lang", "source", "n_chars"])
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id: five-word shingles, similarity 0.8.

    Rows that share a doc_id but not their text all stay; rows without doc_id go where they are copies of others.
    Null, empty and blank texts stay.  An empty table gives no rows.
    """
    return near_duplicates.one_of_each_group(docs.select(*COLUMNS), words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; a document that holds one goes whole.

    Null and empty texts hold none.  Rows are seen one by one, so repeated and null ids do not matter.
    """
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 3 times; repeats have the same doc_id.

    Texts without words are not taken.  A null source is a source of its own; rows of one doc_id, or of none, are
    drawn one by one.  The same documents give the same mix, however they are dealt out.
    """
    copies = mixing.mix(docs, keep=["text", "lang", "n_chars"])
    repeated = copies.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return repeated.select(*COLUMNS)


def token_store_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written to a token store and read back: doc_id, start, n_tokens, ids_crc32.

    Null texts are empty and have the end id only; null ids come first, no row is dropped.
    """
    path = scratch(spark, "pipeline-token-store")
    token_store.write_store(docs, path, tokenizer("word_bpe_49k.json"))
    return token_store.read_store(spark, path)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token store", token_store_stage),
]

# The classifier, the rounding and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{scratch(spark, 'pipeline')}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
