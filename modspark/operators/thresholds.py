"""Threshold search from one pass of bucket counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.numbers import at_least, f1


def grid_counts(
    long: DataFrame, keys: Sequence[str] = (), grid: Sequence[float] = K.THRESHOLD_GRID
) -> DataFrame:
    """``keys, label, threshold, tp, fp, fn`` for every grid point.

    A row falls in the bucket given by how many grid points it reaches. Counts per bucket
    (at most len(grid) + 1 per label) are all the search needs; the data is read once,
    not once per threshold.
    """
    points = sorted(float(t) for t in grid)
    bucket = sum((at_least(F.col("p"), t).cast("int") for t in points), F.lit(0))
    counts = long.groupBy(*keys, "label", bucket.alias("bucket")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    steps = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(points, 1)]
    )
    hit = F.col("bucket") >= F.col("i")
    return (
        counts.select("*", F.inline(steps))
        .groupBy(*keys, "label", "threshold")
        .agg(
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        )
    )


def best_per_label(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, label, threshold, f1``; of equal F1 values the lowest threshold wins."""
    score = f1(F.col("tp"), F.col("fp"), F.col("fn"))
    best = F.max(F.struct(score.alias("f1"), (-F.col("threshold")).alias("low"))).alias("best")
    return (
        counts.groupBy(*keys, "label")
        .agg(best)
        .select(*keys, "label", (-F.col("best.low")).alias("threshold"), F.col("best.f1").alias("f1"))
    )


def best_global(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, threshold, f1_micro, f1_macro`` with the best micro F1, lowest threshold first."""
    per = counts.groupBy(*keys, "threshold").agg(
        f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("f1_micro"),
        F.avg(f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("f1_macro"),
    )
    best = F.max(F.struct("f1_micro", (-F.col("threshold")).alias("low"), "f1_macro")).alias("best")
    out = per.agg(best) if not keys else per.groupBy(*keys).agg(best)
    return out.select(*keys, (-F.col("best.low")).alias("threshold"), "best.f1_micro", "best.f1_macro")


def apply_thresholds(long: DataFrame, thresholds: DataFrame, on: Sequence[str] = ("label",)) -> DataFrame:
    """Add ``threshold`` and ``pred`` to scored rows.

    ``thresholds`` has one row per label and is broadcast; with ``on=()`` it is one row in
    all and becomes a scalar subquery.
    """
    if on:
        joined = long.join(F.broadcast(thresholds.select(*on, "threshold")), list(on))
    else:
        joined = long.withColumn("threshold", thresholds.select("threshold").scalar())
    return joined.withColumn("pred", at_least(F.col("p"), F.col("threshold")).cast("int"))
