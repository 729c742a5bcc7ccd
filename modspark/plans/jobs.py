"""Jobs over stored tables: each reads folders, runs operators, and writes folders."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.config import AgentSettings, LogSettings, PolicyRules, SplitSettings
from modspark.functions.language import UNKNOWN
from modspark.functions.numbers import f1, parse_number
from modspark.operators import governance, langid, metrics, monitoring, tfidf
from modspark.operators.moderation import ScorerSet, moderate
from modspark.operators.prepare import prepare_three_class
from modspark.operators.sampling import cap_rows, class_splits, evaluation_split
from modspark.operators.scoring import BatchScorer, ColumnScorer, Scorer
from modspark.operators.thresholds import apply_thresholds
from modspark.plans import reports
from modspark.sources import datasets, logs
from modspark.sources.reports import save_report
from modspark.sources.requests import request_texts


def prepare(
    spark: SparkSession,
    paths: dict[str, str],
    out: str,
    text_field: str,
    label_fields: Sequence[str],
    id_field: str,
    fmt: str = "parquet",
    negative_ratio: float = 1.0,
    settings: SplitSettings = SplitSettings(),
    split_csv: bool = False,
) -> None:
    """``split_csv`` says that CSV files have no line ends inside quotes, so many tasks can read a file."""
    options = {"multiLine": False} if fmt == "csv" and split_csv else {}
    found = datasets.load_splits(spark, paths, label_fields, fmt, **options)
    rows = datasets.load_prepared(found, text_field, label_fields, id_field, negative_ratio, settings)
    datasets.export_splits(rows, out)


def split_rows(spark: SparkSession, path: str, split: str, max_rows: int | None = None) -> DataFrame:
    """One split of a prepared table; "eval" is test, or validation if test is empty."""
    rows = spark.read.parquet(path)
    rows = evaluation_split(rows) if split == "eval" else rows.filter(F.col("split") == split)
    return cap_rows(rows, max_rows, ["id"])


def train(spark: SparkSession, path: str, out: str, label_fields: Sequence[str], settings: tfidf.TfidfSettings) -> None:
    tfidf.train_tfidf_lr(split_rows(spark, path, "train"), label_fields, settings).save(out)


def tune(
    spark: SparkSession, path: str, out: str, label_fields: Sequence[str], grid: dict, max_trials: int = 6, store: str | None = None
) -> None:
    parts = [split_rows(spark, path, s) for s in ("train", "validation")]
    grid = {k: [tuple(v) if isinstance(v, list) else v for v in values] for k, values in grid.items()}
    save_report(tfidf.tune(*parts, label_fields, grid, max_trials, store=store), out)


def load_scorer(spark: SparkSession, spec: str, label_fields: Sequence[str], name: str) -> Scorer | None:
    """A scorer by its description; None for a model folder that does not exist.

    ``column:NAME`` takes stored scores, ``MODULE:FUNCTION`` a Python model (the function
    returns one from texts to scores), anything else is the folder of a fitted model.
    """
    if spec.startswith("column:"):
        return ColumnScorer(name, label_fields, spec.removeprefix("column:"))
    if re.fullmatch(r"[A-Za-z_][\w.]*:[A-Za-z_]\w*", spec):
        module, function = spec.split(":")
        return BatchScorer(name, label_fields, getattr(importlib.import_module(module), function))
    if datasets.read_or_none(spark, f"{spec}/metadata", "text") is None:
        return None
    return tfidf.TfidfModel.load(spec)


def prepare_classes(spark: SparkSession, path: str, out: str, fmt: str = "parquet") -> None:
    """Three-class rows to a prepared table by split, and a summary of its splits."""
    raw = datasets.read_or_none(spark, path, fmt)
    if raw is None:
        raise FileNotFoundError(path)
    rows = class_splits(prepare_three_class(raw), ["id"], has_split=K.CLASS_SPLIT_COLUMN in raw.columns)
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{out}/rows")
    save_report(metrics.split_summary(spark.read.parquet(f"{out}/rows")), f"{out}/summary")


def apply_stored_thresholds(
    spark: SparkSession, path: str, model: str, thresholds: str, out: str, label_fields: Sequence[str], split: str = "eval"
) -> None:
    """Counts and F1 per label at the thresholds that a search has stored."""
    scorer = load_scorer(spark, model, label_fields, "model")
    if scorer is None:
        raise FileNotFoundError(f"no model in {model}")
    long = metrics.to_long(scorer.score(split_rows(spark, path, split), "text", "probs"), label_fields)
    stored = spark.read.schema("label string, threshold double").json(thresholds)
    at = apply_thresholds(long, stored)
    counts = metrics.confusion(at, threshold=F.col("threshold")).join(F.broadcast(stored), "label")
    save_report(counts.withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn"))), out)


def drift(spark: SparkSession, log: str, out: str, reference_until: str) -> None:
    """Daily distance of a log's signals from those of the days up to a date."""
    rows, _ = logs.read_prediction_log(spark, log)
    rows = rows.withColumn("day", F.to_date(F.substring("ts_utc", 1, 10)))
    rows = rows.withColumn("overall_score", parse_number(F.col("overall_score").cast("string")))
    counts = monitoring.signal_counts(rows, "day", monitoring.log_signals())
    save_report(monitoring.drift(counts, "day", F.col("day") <= F.lit(reference_until).cast("date")), out)


def retrain(spark: SparkSession, queue: str, reviewed: str, train_rows: str, out: str) -> None:
    """The next training set: the last one and what reviewers have labelled of the queue."""
    merged = monitoring.retraining_set(
        logs.read_review_queue(spark, queue), spark.read.parquet(reviewed), spark.read.parquet(train_rows)
    )
    merged.write.mode("overwrite").parquet(out)


def scan_for_leaks(spark: SparkSession, path: str, out: str) -> None:
    save_report(governance.leak_scan(spark.read.json(path)), out)


def evaluate(
    spark: SparkSession, path: str, models: dict[str, str], out: str, label_fields: Sequence[str], threshold: float = 0.5
) -> None:
    """Compare stored models on the same rows; a model whose folder is missing is noted."""
    rows = split_rows(spark, path, "eval")
    parts = []
    for name, spec in models.items():
        scorer = load_scorer(spark, spec, label_fields, name)
        if scorer is None:
            continue
        scored = scorer.score(rows, "text", "probs")
        parts.append(metrics.to_long(scored, label_fields).withColumn("model", F.lit(name)))
    listed = spark.createDataFrame([(m,) for m in models], "model string")
    if not parts:
        raise FileNotFoundError(f"no model found in {models}")
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    save_report(metrics.compare_models(long, listed, threshold), out)


def analyse(
    spark: SparkSession,
    path: str,
    model: str,
    out: str,
    label_fields: Sequence[str],
    build: dict[str, Callable[[DataFrame], reports.Report]],
    split: str = "eval",
    max_rows: int | None = None,
) -> None:
    """Score one split once and write the chosen reports from it."""
    scorer = load_scorer(spark, model, label_fields, "model")
    if scorer is None:
        raise FileNotFoundError(f"no model in {model}")
    if list(scorer.labels) != list(label_fields):
        raise ValueError(f"the model scores {list(scorer.labels)}, not {list(label_fields)}")
    scored = scorer.score(split_rows(spark, path, split, max_rows), "text", "probs")
    reports.save_all(scored, build, lambda table, name: save_report(table, f"{out}/{name}"))


def scorer_set(spark: SparkSession, specs: dict[str, str]) -> ScorerSet:
    """Scorers by route; the vi route has labels of its own."""
    found = {}
    for route, spec in specs.items():
        fields = K.VIETNAMESE_LABELS if route == "vi" else K.ENGLISH_LABELS
        found[route] = load_scorer(spark, spec, fields, route)
        if found[route] is None:
            raise FileNotFoundError(f"no model in {spec}")
    return ScorerSet(**found)


def moderate_table(
    spark: SparkSession,
    path: str,
    model: str,
    out: str,
    language_table: str | None = None,
    settings: AgentSettings = AgentSettings(),
    policy: PolicyRules = PolicyRules(),
    logging: LogSettings = LogSettings(),
    run: str | None = None,
    others: dict[str, str] | None = None,
) -> None:
    """Decide over a table of texts or requests; adds to ``out/log`` and ``out/queue``.

    Every run adds to both. A run with a name can be started again: it then replaces what it
    added before. A run that is killed adds nothing to the sink it was writing.

    Language comes from a ``lang`` column, or from a trigram model trained on
    ``language_table`` (``text, lang``).
    """
    rows = spark.read.parquet(path)
    if "texts" in rows.columns:
        rows = request_texts(rows)
    if language_table is not None:
        rows = langid.with_language(rows, langid.train(spark.read.parquet(language_table)))
    elif "lang" not in rows.columns:
        rows = rows.withColumn("lang", F.lit(UNKNOWN))
    scorers = scorer_set(spark, {"fast": model} | (others or {}))
    decided = moderate(rows, scorers, settings, policy, with_redaction=logging.store_redacted_text)
    # both sinks read the decisions; score once
    decided = decided.persist()
    try:
        stamp = F.current_timestamp()
        logs.append_json(logs.prediction_records(decided, stamp, logging), f"{out}/log", run)
        logs.append_json(logs.review_records(decided, stamp), f"{out}/queue", run)
    finally:
        decided.unpersist()


def report(spark: SparkSession, log: str, out: str, daily: bool = False) -> None:
    rows, _ = logs.read_prediction_log(spark, log)
    keys = ["day"] if daily else []
    rows = rows.withColumn("day", F.to_date(F.substring("ts_utc", 1, 10)))
    save_report(monitoring.report(rows, keys), out)


def latency(spark: SparkSession, path: str, column: str, out: str) -> None:
    save_report(monitoring.latency_summary(spark.read.parquet(path), column), out)


def default_labels() -> list[str]:
    return list(K.ENGLISH_LABELS)
