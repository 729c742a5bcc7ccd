"""Inputs for the registered queries, derived from the given tables.

The scores here come from hashes, so that another engine can compute the same numbers.
They stand in for a model's output and are not a model.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.config import AgentSettings, PolicyRules
from modspark.functions.language import guarded
from modspark.functions.numbers import bind
from modspark.functions.text import content_hash
from modspark.operators.moderation import ScorerSet, moderate
from modspark.operators.scoring import ExpressionScorer
from modspark.sources.settings_files import load_groups, load_policy

LABELS = ("toxic", "quality")
AGENT = AgentSettings(forced_languages=("vi",))
# words that do occur in the given texts, instead of identity terms
TERM_GROUPS = {
    "articles": ["the", "le", "der"],
    "verbs": ["was", "est", "ist"],
    "copulas": ["that", "which"],
    "nobody": ["zyzzyva"],
    "blank": ["  "],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """A table of texts as it is stored.

    A session may ask with ``modspark.spread`` to deal texts out to its cores first: the
    small given files are one row group each, which one task reads. Sizes play no part.
    """
    df = table(spark, sf_dir, name)
    if spark.conf.get("modspark.spread", "false") == "true":
        return df.repartition(spark.sparkContext.defaultParallelism, key)
    return df


def uniform(text_hash: Column, label: str, salt: str) -> Column:
    """A number in [0, 1) from a text hash, a label and a salt."""
    digest = F.sha2(F.concat(text_hash, F.lit(f"|{salt}|{label}")), 256)
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("double") / F.lit(16777216.0)


def agent_scores(text: Column, labels: Sequence[str], salt: str) -> Column:
    """Scores with many small values, so that every action occurs."""

    def scores(h: Column) -> Column:
        us = F.array(*[uniform(h, x, salt) for x in labels])
        return F.transform(us, lambda u: (u * u * u * u).cast("float"))

    # hashing the text is the costly part
    return bind(content_hash(text), scores)


def stand_in_scorer(salt: str, labels: Sequence[str] = K.ENGLISH_LABELS) -> ExpressionScorer:
    return ExpressionScorer(salt, labels, lambda text: agent_scores(text, labels, salt))


def scorers() -> ScorerSet:
    return ScorerSet(
        fast=stand_in_scorer("fast"),
        multilingual=stand_in_scorer("multi"),
        finetuned=stand_in_scorer("tuned"),
        vi=stand_in_scorer("vi", K.VIETNAMESE_LABELS),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, n_chars, lang`` with stand-in languages.

    Spanish plays Vietnamese, and one source plays a failed language detection.
    """
    detected = (
        F.when(F.col("source") == "src3", F.lit(None))
        .when(F.col("lang") == "es", F.lit("vi-VN"))
        .when(F.col("lang") == "en", F.lit("en-US"))
        .otherwise(F.col("lang"))
    )
    docs = texts(spark, sf_dir)
    return docs.select("doc_id", "text", "n_chars", guarded(F.col("text"), detected).alias("lang"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderate(messages(spark, sf_dir), scorers(), AGENT)


def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions with a time stamp and without text: every event is a request for some document."""
    n_docs = table(spark, sf_dir, "documents").count()
    clock = table(spark, sf_dir, "events").select((F.col("event_id") % F.lit(max(1, n_docs))).alias("doc_id"), "ts")
    log = decisions(spark, sf_dir).select(
        "doc_id",
        content_hash(F.col("text")).alias("text_sha256"),
        "n_chars",
        "action",
        "overall_score",
        "label_scores",
        "model_used",
        "language",
        "request_human_review",
    )
    return log.join(clock, "doc_id", "left").withColumn("day", F.to_date("ts"))


SETTINGS = Path(__file__).with_name("settings")
"""Settings files of the registered queries; the driver program alone reads them."""


def stored_groups() -> dict[str, list[str]]:
    return load_groups(str(SETTINGS / "groups.json"))


def stored_policy() -> PolicyRules:
    """A policy that names every action after itself."""
    return load_policy(str(SETTINGS / "policy.json"))


def score_columns(text_hash: Column, salt: str) -> list[Column]:
    return [uniform(text_hash, x, salt).alias(f"u_{x}") for x in LABELS]


def _probs(salt: str = "eval") -> Column:
    """Scores that lean towards the label."""
    return F.array(
        *[(0.7 * F.col(f"u_{x}") + 0.3 * F.col(x)).cast("float") for x in LABELS]
    )


def scored(
    spark: SparkSession, sf_dir: str, with_text: bool = False, salt: str = "eval"
) -> DataFrame:
    """``id, [text], labels, probs`` of the labelled documents.

    Without text only ids and scores travel through the join.
    """
    docs = texts(spark, sf_dir)
    truth = table(spark, sf_dir, "labels").select("doc_id", *LABELS)
    kept = ["doc_id", "text"] if with_text else ["doc_id"]
    if with_text:
        # hash after the join, so that unlabelled texts are not hashed
        rows = docs.select(*kept).join(truth, "doc_id")
        rows = rows.select("*", content_hash(F.col("text")).alias("h"))
        rows = rows.select(*kept, *LABELS, *score_columns(F.col("h"), salt))
    else:
        rows = docs.select("doc_id", content_hash(F.col("text")).alias("h"))
        rows = rows.select("doc_id", *score_columns(F.col("h"), salt)).join(truth, "doc_id")
    labels = F.array(*[F.col(x).cast("double") for x in LABELS]).alias("labels")
    return rows.select(
        F.col("doc_id").alias("id"), *(["text"] if with_text else []), labels, _probs(salt).alias("probs")
    )


def class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-class rows ``free_text, label_id, type`` in the mixed spellings such data has."""
    docs = texts(spark, sf_dir).select("doc_id", "text", "lang")
    truth = table(spark, sf_dir, "labels")
    bad, good = F.col("toxic") == 1, F.col("quality") == 1
    label = (
        F.when(bad & good, F.lit(" Offensive "))
        .when(bad, F.lit("hate"))
        .when(good, F.lit("1.9"))
        .when(F.col("toxic") == 0, F.lit("spam"))
    )
    split = (
        F.when(F.col("lang") == "en", F.lit("Training "))
        .when(F.col("lang") == "fr", F.lit("DEV"))
        .when(F.col("lang") == "de", F.lit("testing"))
        .otherwise(F.lit("Holdout"))
    )
    return docs.join(truth, "doc_id", "left").select(
        F.col("text").alias("free_text"), label.alias("label_id"), split.alias("type")
    )


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training histories from events: a user is a run, event ids are steps."""

    def only(kind: str, scale: float) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value") / scale)

    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        only("view", 100.0).alias("loss"),
        only("error", 100.0).alias("eval_loss"),
        only("click", 1000.0).alias("eval_f1_micro"),
        only("signup", 1000.0).alias("best_metric"),
    )
