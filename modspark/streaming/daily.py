"""Live counts by action and language with the mean score, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modspark.operators.monitoring import NO_ACTION, NO_LANGUAGE


def daily_counts(log: DataFrame, ts: str = "ts", late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """``day, action, language, n, mean_score``; works on a stream and on a table.

    State is one row per open day, action and language. Rows later than ``late`` are dropped.
    """
    if log.isStreaming:
        log = log.withWatermark(ts, late)
    score = F.coalesce(F.col("overall_score").cast("string"), F.lit("0")).try_cast("double")
    return (
        log.groupBy(
            F.window(ts, width).alias("w"),
            F.coalesce("action", F.lit(NO_ACTION)).alias("action"),
            F.coalesce("language", F.lit(NO_LANGUAGE)).alias("language"),
        )
        .agg(F.count("*").alias("n"), F.coalesce(F.avg(score), F.lit(0.0)).alias("mean_score"))
        .select(F.col("w.start").alias("day"), "action", "language", "n", "mean_score")
    )


def append_closed_days(
    counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write each day once, when the watermark has passed its end."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def update_open_days(
    counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the changed rows of every micro-batch to a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_days(updates: DataFrame) -> DataFrame:
    """The newest row per day, action and language of ``update_open_days`` output."""
    newest = F.max_by(F.struct("n", "mean_score"), "batch_id").alias("v")
    return updates.groupBy("day", "action", "language").agg(newest).select(
        "day", "action", "language", "v.n", "v.mean_score"
    )


def compact_days(updates: DataFrame, path: str, before: str) -> None:
    """Write the final counts of all days before ``before`` once, one folder per day.

    Run again, it replaces the days it finds and leaves others alone. The update folders of
    these days may then go; ``all_days`` reads both.
    """
    closed = latest_days(updates.filter(F.to_date("day") < F.lit(before).cast("date")))
    closed = closed.withColumn("dt", F.to_date("day"))
    closed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def all_days(updates: DataFrame, compacted: DataFrame, before: str) -> DataFrame:
    """Counts of all days: closed ones from the compacted table, open ones from the updates."""
    closed = compacted.filter(F.col("dt") < F.lit(before).cast("date")).drop("dt")
    return closed.unionByName(latest_days(updates.filter(F.to_date("day") >= F.lit(before).cast("date"))))
