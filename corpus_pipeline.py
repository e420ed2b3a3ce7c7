"""The corpus pipeline: quality classifier, line de-duplication, SimHash near-duplicates, decontamination, BPE.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, and returns a DataFrame with the
columns of documents; the last one returns the encoded documents. ``run`` writes each stage as Parquet in the shared
folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import bpe, decontamination, line_dedup, quality_classifier, simhash_dedup
from triplake.llm.catalog import WORD_BPE
from triplake.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars as the length of the text it now has."""
    return df.withColumn("n_chars", F.length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among ``docs``."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    rated = quality_classifier.score(docs.select(*COLUMNS), model, *COLUMNS)
    return _documents(rated.where(F.col("__score") >= quality_classifier.THRESHOLD))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later places of repeated runs of lines."""
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (any one if no member has an id)."""
    found = simhash_dedup.near_duplicates(docs, *COLUMNS)
    first = (F.col("doc_id") == F.col("component_id")) | F.col("component_id").isNull()
    return _documents(found.where(first).dropDuplicates(["root"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _documents(decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded documents: doc_id, n_tokens, ids, decoded."""
    path = public_tokenizers.path(WORD_BPE)
    out = bpe.encode(docs, path, "doc_id", decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination_stage), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else written(out, "stage")
    return docs


# Trees, hash-selected grams and byte-pair merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None
