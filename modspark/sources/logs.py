"""Prediction log and review queue: append-only JSON lines, partitioned by day.

Every append is an attempt with a folder of its own, and counts once a commit names it. A
run that is killed leaves an attempt without a commit, which readers pass over; a run that
is repeated under its name is committed again, and the later commit takes the place of the earlier.
Nothing that is committed is ever overwritten. Spark's own writers do all of it, so a log can
be in any store that Spark writes to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import schemas
from modspark.config import LogSettings
from modspark.functions.numbers import computed_once
from modspark.functions.text import content_hash
from modspark.sources.datasets import read_or_none

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def prediction_records(
    decisions: DataFrame,
    ts: Column | None = None,
    settings: LogSettings = LogSettings(),
    text: str = "text",
) -> DataFrame:
    """Log records of decisions. Only the hash of a text is kept unless settings say otherwise."""
    stamp = F.current_timestamp() if ts is None else ts
    columns = [
        F.date_format(stamp, _ISO).alias("ts_utc"),
        content_hash(F.col(text)).alias("text_sha256"),
        "action",
        "overall_score",
        "label_scores",
        "model_used",
        "language",
        "request_human_review",
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
    ]
    if settings.store_raw_text:
        columns.append(F.col(text).alias("text"))
    if settings.store_redacted_text and "text_redacted" in decisions.columns:
        columns.append("text_redacted")
    return decisions.select(*columns, F.to_date(stamp).alias("dt"))


def review_records(decisions: DataFrame, ts: Column | None = None, text: str = "text") -> DataFrame:
    """Queue records of the decisions that ask for a human."""
    stamp = F.current_timestamp() if ts is None else ts
    asked = decisions.filter("request_human_review")
    return asked.select(
        F.date_format(stamp, _ISO).alias("ts_utc"),
        content_hash(F.col(text)).alias("text_sha256"),
        "language",
        "overall_score",
        "label_scores",
        "model_used",
        F.to_date(stamp).alias("dt"),
    )


COMMITS = "_commits"
COMMIT = "run string, attempt string, at timestamp"


def append_json(records: DataFrame, path: str, run: str | None = None) -> None:
    """Add records by day, all of them or none.

    A run's name makes it repeatable: what it added before is replaced when the new records
    are complete. Without a name every call is a run of its own.
    """
    attempt = f"a-{uuid.uuid4().hex}"
    records.write.partitionBy("dt").json(f"{path}/attempt={attempt}")
    commit = records.sparkSession.range(1, numPartitions=1).select(
        F.lit(run or attempt).alias("run"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("at")
    )
    # a folder of its own: writers that commit at the same time do not meet
    commit.write.json(f"{path}/{COMMITS}/{attempt}")


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """``run, attempt``: what readers of a log count; None if nothing was ever committed."""
    found = read_or_none(spark, f"{path}/{COMMITS}/*", "json", COMMIT)
    if found is None:
        return None
    return found.groupBy("run").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))


def _only_committed(df: DataFrame, path: str) -> DataFrame:
    """Rows of committed attempts; files that were put there by other means all count."""
    if "attempt" not in df.columns:
        return df
    done = committed(df.sparkSession, path)
    if done is None:
        return df.filter("attempt IS NULL").drop("attempt")
    return df.join(done.select("attempt"), "attempt", "left_semi").drop("attempt")


def read_prediction_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(log, bad)``: readable records, and the lines that are no JSON record.

    Blank lines are skipped; a missing path is an empty log. Scores stay text here and are
    parsed by the reports, label by label. Lines are read as text and parsed whole, since
    a JSON scan of a few columns would let a broken line pass.
    """
    lines = read_or_none(spark, path, "text")
    if lines is None:
        lines = spark.createDataFrame([], "value string, dt date")
    lines = _only_committed(lines, path)
    lines = lines.filter(F.trim(F.translate("value", "\t\r", "  ")) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn(
        "_r", computed_once(F.from_json("value", schemas.PREDICTION_LOG_READ, options))
    )
    kept = [c for c in lines.columns if c != "value"]
    fields = [c for c in schemas.PREDICTION_LOG_READ.names if c != "_bad"]
    log = parsed.filter(F.col("_r").isNotNull() & F.col("_r._bad").isNull())
    bad = parsed.filter(F.col("_r").isNull() | F.col("_r._bad").isNotNull())
    scores = F.from_json("label_scores", "map<string,string>")
    log = log.select(*[F.col(f"_r.{c}") for c in fields], *kept).withColumn("label_scores", scores)
    return log, bad.select(F.col("value").alias("line"))


def read_review_queue(spark: SparkSession, path: str) -> DataFrame:
    df = read_or_none(spark, path, "json", schemas.REVIEW_QUEUE)
    return spark.createDataFrame([], schemas.REVIEW_QUEUE) if df is None else _only_committed(df, path)
