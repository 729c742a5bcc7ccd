"""Exact order statistics without bringing a group into one task.

Both helpers rest on cells: a cell number grows with the value, so counts per cell give
every rank up to the cell that holds it, and only that cell is looked into.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS_PER_OCTAVE = 128
SUBCELLS = 16384
# 64-bit floats reach from 2**-1074 to 2**1024
_OCTAVES = 1080


def value_cell(value: Column) -> Column:
    """Monotone cell number of a number: its sign and position on a logarithmic scale.

    At most 2 * 2104 * 128 + 1 cells exist for doubles, and for 32-bit floats a cell holds
    fewer than 91,000 distinct values, whatever the data.
    """
    largest = F.lit(sys.float_info.max)
    size = F.least(F.abs(value.cast("double")), largest)
    step = F.floor(F.log2(size) * CELLS_PER_OCTAVE).cast("int") + F.lit(_OCTAVES * CELLS_PER_OCTAVE)
    # infinities and NaN (above all numbers) have cells of their own
    top = 2 * _OCTAVES * CELLS_PER_OCTAVE
    return (
        F.when(F.isnan(value), top + 1)
        .when(value > largest, top)
        .when(value < -largest, -top)
        .when(value > 0, step)
        .when(value < 0, -step)
        .otherwise(F.lit(0))
    )


def _before(df: DataFrame, keys: Sequence[str], order: str, weight: str, name: str) -> DataFrame:
    """Running total of ``weight`` over all smaller ``order`` values within the keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(weight).over(w), F.lit(0)))


def exact_percentiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    fractions: Sequence[float],
) -> DataFrame:
    """Linear-interpolated percentiles per key: ``keys, n, mean, p array<double>``.

    ``counts`` holds one row per key and distinct value with its number of occurrences.
    Three steps narrow each wanted rank down: logarithmic cells, then equal-width cells
    inside the cell that holds the rank, then the values of one such cell.
    """
    # Keys packed in a struct and a cell that is never null leave Spark no null filters to
    # add on one side of a join, so both uses of the counts share one exchange.
    base = counts.select(
        F.struct(*keys).alias("_k"),
        F.col(value).cast("double").alias("_v"),
        F.col(weight).cast("long").alias("_w"),
        F.coalesce(value_cell(F.col(value)), F.lit(0)).alias("_cell"),
    )
    cells = base.groupBy("_k", "_cell").agg(
        F.sum("_w").alias("_w"),
        F.sum(F.col("_v") * F.col("_w")).alias("_total"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    )
    whole = Window.partitionBy("_k")
    cells = _before(cells, ["_k"], "_cell", "_w", "_below").withColumns(
        {"_n": F.sum("_w").over(whole), "_sum": F.sum("_total").over(whole)}
    )
    # a percentile lies between the values at two neighbouring ranks
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("_i"), F.lit(side).alias("_side"), rank.alias("_rank"))
            for i, q in enumerate(fractions)
            for side, rank in enumerate(_neighbours(q, F.col("_n")))
        ]
    )
    cut = (
        cells.select("*", F.inline(wanted))
        .filter(_holds("_rank", "_below", "_w"))
        .select(
            "_k",
            "_cell",
            "_i",
            "_side",
            "_n",
            "_lo",
            "_hi",
            (F.col("_sum") / F.col("_n")).alias("_mean"),
            (F.col("_rank") - F.col("_below")).alias("_rank"),
        )
    )
    # inside the cell: equal-width cells between its least and greatest value
    target = ["_k", "_i", "_side"]
    part = F.when(
        F.col("_hi") > F.col("_lo"),
        F.nanvl(F.try_divide((F.col("_v") - F.col("_lo")) * SUBCELLS, F.col("_hi") - F.col("_lo")), F.lit(0.0)),
    )
    held = base.join(cut, ["_k", "_cell"]).select(
        *target, "_n", "_mean", "_rank", "_v", "_w", F.coalesce(part, F.lit(0.0)).cast("int").alias("_sub")
    )
    subs = held.groupBy(*target, "_sub").agg(F.sum("_w").alias("_w"), F.first("_rank").alias("_rank"))
    subs = _before(subs, target, "_sub", "_w", "_below").filter(_holds("_rank", "_below", "_w"))
    inner = held.drop("_rank").join(
        subs.select(*target, "_sub", (F.col("_rank") - F.col("_below")).alias("_rank")), [*target, "_sub"]
    )
    inner = _before(inner, target, "_v", "_w", "_below").filter(_holds("_rank", "_below", "_w"))

    def at(i: int, side: int) -> Column:
        return F.max(F.when((F.col("_i") == i) & (F.col("_side") == side), F.col("_v")))

    points = [
        F.when(at(i, 0) == at(i, 1), at(i, 0)).otherwise(
            at(i, 0) + (at(i, 1) - at(i, 0)) * _excess(q, F.first("_n"))
        )
        for i, q in enumerate(fractions)
    ]
    out = inner.groupBy("_k").agg(
        F.first("_n").alias("n"), F.first("_mean").alias("mean"), F.array(*points).alias("p")
    )
    return out.select(*[F.col(f"_k.{k}").alias(k) for k in keys], "n", "mean", "p")


def _holds(rank: str, below: str, weight: str) -> Column:
    return (F.col(rank) >= F.col(below)) & (F.col(rank) < F.col(below) + F.col(weight))


def _position(q: float, n: Column) -> Column:
    return F.lit(float(q)) * (n - 1)


def _excess(q: float, n: Column) -> Column:
    return _position(q, n) - F.floor(_position(q, n))


def _neighbours(q: float, n: Column) -> list[Column]:
    return [f(_position(q, n)).cast("long") for f in (F.floor, F.ceil)]


def count_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key and distinct value, counted before the shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("w"))


KEY_BITS = 60
_CELL_BITS = 20


def smallest_keys_cut(keys: DataFrame, key: str, k: int | None, share: float | None = None):
    """Where to cut so that exactly ``k`` rows lie at or below: ``(cut, spare, total)``.

    ``key`` is a 60-bit hash. One aggregate over 2**20 cells finds the cell that holds rank
    k; only that cell is counted by key. ``spare`` is the number of rows at the cut itself
    that must be left out (copies of one row). With ``share`` k is that part of all rows.
    The driver sees one row per step.
    """
    cell = F.shiftright(F.col(key), KEY_BITS - _CELL_BITS)
    hist = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("w"))
    run = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    steps = hist.withColumn("upto", F.sum("w").over(run))
    if k is None:
        # the histogram is bounded, so the total and the cell come from one job
        steps = steps.withColumn("total", F.sum("w").over(Window.partitionBy()))
        wanted = F.floor(F.col("total") * F.lit(float(share))).cast("long")
    else:
        steps = steps.withColumn("total", F.lit(None).cast("long"))
        wanted = F.lit(int(k))
    steps = steps.withColumn("k", wanted).filter((F.col("upto") >= F.col("k")) & (F.col("k") > 0))
    found = steps.orderBy("cell").first() if k is None or k > 0 else None
    if found is None:
        # nothing wanted, or more than there is
        return (None if k is None or k <= 0 else 1 << KEY_BITS), 0, None
    k, total = found["k"], found["total"]
    below = found["upto"] - found["w"]
    inside = keys.filter(cell == found["cell"]).groupBy(key).agg(F.count("*").alias("w"))
    run = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    at = (
        inside.withColumn("upto", F.sum("w").over(run))
        .filter(F.col("upto") >= k - below)
        .orderBy(key)
        .first()
    )
    return at[key], below + at["upto"] - k, total


def drop_any(df: DataFrame, condition: Column, spare: int) -> DataFrame:
    """Leave out ``spare`` of the rows that meet ``condition``, rows that tie on their key.

    A hash of the whole row decides between them, so the result rests on the rows alone and
    not on where they lie. Rows that are equal in every column collapse to one, which is
    then repeated as often as it has to stay.
    """
    if spare <= 0:
        return df
    whole = F.shiftrightunsigned(F.xxhash64(F.to_json(F.struct(*df.columns))), 64 - KEY_BITS)
    tied = df.filter(condition).withColumn("_whole", whole)
    cut, extra, _ = smallest_keys_cut(tied.select("_whole"), "_whole", tied.count() - spare)
    plain = df.filter(~condition)
    if cut is None:
        return plain
    equal = tied.filter(F.col("_whole") == cut)
    copies = F.explode(F.sequence(F.lit(1), F.lit(equal.count() - extra))).alias("_copy")
    repeated = equal.limit(1).select("*", copies).select(*df.columns)
    return plain.unionByName(tied.filter(F.col("_whole") < cut).select(*df.columns)).unionByName(repeated)
