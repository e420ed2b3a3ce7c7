"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, decontamination, kneser_ney, line_dedup, oracle, pii, quality_classifier, quality_rules,
               simhash_dedup, spelling, stream_dedup, token_files, url_filter)
from .common import remainder, scratch, table


BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(table(spark, sf_dir, "documents"), "doc_id")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"), "doc_id")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def only(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = pii.KINDS[:4]
    return found.select(
        "doc_id", *[F.size(only(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(only(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.encode_and_read(docs, public_tokenizers.path(BYTE_BPE), "ids_crc32 bigint",
                                       token_files.crc32_ids)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    out = bpe.encode(table(spark, sf_dir, "documents"), path, "doc_id", decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    out = quality_classifier.score(docs, model, "doc_id")
    held = F.coalesce(remainder(F.col("doc_id"), quality_classifier.FOLDS) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    model = kneser_ney.train(docs.where(~held).select("text"))
    out = kneser_ney.score(docs.select("doc_id", "text"), model, "doc_id")
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), "page_id")


def op11_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "stream-dedup")
    stream_dedup.advance(stream_dedup.stream(spark, f"{sf_dir}/documents.parquet"), folder)
    return stream_dedup.result(table(spark, sf_dir, "documents"), folder).withColumnRenamed("digest", "text_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                               public_tokenizers.path(PIECE_BPE))


_QUERIES = [op1_quality_rules, op2_personal_data, op3_token_files, op4_decontamination, op5_simhash_dedup, op6_bpe,
            op7_line_dedup, op8_quality_classifier, op9_language_model, op10_url_filter,
            op11_stream_dedup, op12_spelling_variants, op13_token_alignment]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLE_SQL)
