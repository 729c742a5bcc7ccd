"""A corpus from raw documents: every stage reads what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modspark.llm import quality, toxicity
from modspark.llm.decontamination import decontaminated
from modspark.llm.jaccard_join import one_of_each
from modspark.llm.mixing import mixed
from modspark.llm.queries import fold, table
from modspark.llm.store import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LIMIT = 0.3
"""From this score on a text counts as toxic, and as good."""


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"), fold(4) == 2)
    return toxicity.scored(docs, model).filter(f"score < {LIMIT}").select(*docs.columns)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as low quality go."""
    model = quality.fitted(docs, table(spark, sf_dir, "labels"), fold(5) == 0)
    return quality.scored(docs, model).filter(f"score >= {LIMIT}").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays."""
    return one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it."""
    return mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", to_weights),
]

ORACLE_SQL = None
"""Learned scores and similarity joins have no SQL form; the tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
