"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.llm import decontamination, licenses, line_rules, merkle, mixing, quality, toxicity, warc_zip
from modspark.llm.html_text import extracted
from modspark.llm.jaccard_join import similar_documents
from modspark.llm.lm_scoring import scored
from modspark.llm.super_minhash import near_duplicates
from modspark.llm.token_alignment import alignment


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decided(scores: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score and the decision at 0.3."""
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def fold(folds: int) -> Column:
    """The fold of a document, from its id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), fold(10) == 0)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(licenses.document_paths(table(spark, sf_dir, "documents")), ["doc_id"])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.measured(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).drop("group_id", "text_key")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fitted(docs, labels, fold(5) == 0)
    return decided(quality.scored(docs.select("doc_id", "text"), model), fold(5) == 0)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fitted(docs, labels, fold(4) == 2)
    found = toxicity.scored(docs.select("doc_id", "text"), model)
    return decided(found, fold(4) == 2)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


def op13_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("set_id", "text_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_license_scan": op3_license_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_super_minhash": op13_super_minhash,
}

SQL: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op3_license_scan": licenses.SQL,
    "op4_quality_rules": line_rules.SQL,
    "op6_benchmark_decontamination": decontamination.SQL,
    "op8_warc": warc_zip.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
