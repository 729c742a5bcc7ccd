"""Rolling F1 of a stream of decisions against labels that come later."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modspark.operators.monitoring import hit_counts, label_hits, rolling
from modspark.sources.datasets import read_or_none


@dataclass(frozen=True)
class LabelDelay:
    """How far apart a decision and its label may be, and how late rows may arrive.

    A label counts for a decision if it was given at most ``before`` earlier and ``after`` later. Both
    sides are kept as state until the watermarks rule out a match, so the state holds the rows of
    that time and no more.
    """

    before: str = "1 day"
    after: str = "7 days"
    late: str = "1 hour"


def judged(
    log: DataFrame, truth: DataFrame, label_fields: Sequence[str], delay: LabelDelay = LabelDelay(), threshold: float = 0.5
) -> DataFrame:
    """``day, w, hit0, ..., labels`` of every decision that meets a label, as both streams come in.

    ``log`` has ts, text_sha256, label_scores; ``truth`` has labelled_at, text_sha256, labels, one
    row per text within the delay (one that is sent again is passed over).
    """
    seen = log.withWatermark("ts", delay.late).select("ts", "text_sha256", *label_hits(label_fields, threshold))
    given = (
        truth.withWatermark("labelled_at", delay.late)
        .dropDuplicatesWithinWatermark(["text_sha256"])
        .select("labelled_at", F.col("text_sha256").alias("_hash"), "labels")
    )
    near = (
        f"text_sha256 = _hash AND labelled_at >= ts - INTERVAL {delay.before} AND labelled_at <= ts + INTERVAL {delay.after}"
    )
    return seen.join(given, F.expr(near)).select(F.to_date("ts").alias("day"), F.lit(1).alias("w"), *seen.columns[2:], "labels")


def append_counts(
    rows: DataFrame, label_fields: Sequence[str], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Add each micro-batch's counts ``day, label, n, tp, fp, fn`` to a table.

    A batch writes below its own number and is replaced when it runs again, so every decision is
    counted once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        hit_counts(batch, "day", label_fields).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


COUNTS = "day date, label string, n long, tp long, fp long, fn long"


def current_f1(spark: SparkSession, path: str, days: int = 7) -> DataFrame:
    """``day, label, n, f1`` from what has been counted so far; empty before the first batch."""
    counts = read_or_none(spark, path, "parquet")
    if counts is None:
        counts = spark.createDataFrame([], COUNTS)
    daily = counts.groupBy("day", "label").agg(*[F.sum(c).alias(c) for c in ("n", "tp", "fp", "fn")])
    return rolling(daily, "day", days)
