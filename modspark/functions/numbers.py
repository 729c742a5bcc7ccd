"""Numeric helpers that pin down float width, division and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_least(score: Column, threshold: float | Column) -> Column:
    """``score >= threshold`` in 32-bit arithmetic; NaN never passes.

    Model scores are 32-bit. Comparing them with a 64-bit literal would move scores that
    sit exactly on a grid point to the wrong side.
    """
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= cut.cast("float")) & ~F.isnan(score)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def computed_once(value: Column) -> Column:
    """Keep Spark from copying a costly expression into filters and later projections.

    The condition always holds; being non-deterministic, it pins the column to its place.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def ratio(part: Column, whole: Column) -> Column:
    """Division that yields 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit.cast("double")))


def two_decimals(score: Column) -> Column:
    """Text with two decimals, half-even on the exact binary value of a 32-bit score."""
    exact = score.try_cast("decimal(38,30)")
    return F.coalesce(F.bround(exact, 2).cast("string"), F.lit("nan"))


def parse_number(text: Column) -> Column:
    """Text as a double, null if it does not parse.

    Java also accepts a type suffix ("1d", "1f"), which is no number in a data file.
    """
    return F.when(~text.rlike(r"(?i)[0-9.][df]\s*$"), text.try_cast("double"))
