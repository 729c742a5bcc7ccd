"""Down-sampling, random splits and row caps, repeatable through hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.config import SplitSettings
from modspark.functions.labels import any_positive
from modspark.operators.order_stats import KEY_BITS, drop_any, smallest_keys_cut


def hash_key(columns: Sequence[str], seed: int, method: str = "xxhash64") -> Column:
    """A 60-bit order key of a row.

    xxhash64 is the fast default; sha256 gives the same order in any other engine.
    """
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - KEY_BITS)
    if method == "sha256":
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
        return F.conv(F.substring(F.sha2(text, 256), 1, KEY_BITS // 4), 16, 10).cast("long")
    raise ValueError(f"unknown hash method: {method}")


def hash_fraction(key: Column) -> Column:
    """An order key as a number in [0, 1); 52 bits, so it is exact in a double."""
    return F.shiftright(key, KEY_BITS - 52) / F.lit(float(1 << 52))


def downsample_negatives(
    df: DataFrame,
    ratio: float,
    id_columns: Sequence[str],
    seed: int = 42,
    labels: str = "labels",
    method: str = "xxhash64",
) -> DataFrame:
    """Keep all positives and exactly ``int(n_negatives * ratio)`` negatives.

    The negatives with the smallest order keys stay: two counting jobs find the cut, one
    over a histogram and one over a cell of it, and the result is a filter over the scan.
    """
    if ratio >= 1.0:
        return df
    keyed = df.withColumn("_key", hash_key(id_columns, seed, method))
    negative = ~F.coalesce(any_positive(F.col(labels)), F.lit(False))
    cut, spare, _ = smallest_keys_cut(keyed.filter(negative).select("_key"), "_key", None, ratio)
    if cut is None:
        return df.filter(~negative)
    kept = keyed.filter(~negative | (F.col("_key") <= cut))
    return drop_any(kept, negative & (F.col("_key") == cut), spare).drop("_key")


def cap_rows(
    df: DataFrame, n: int | None, id_columns: Sequence[str], seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """At most ``n`` rows: those with the smallest order keys."""
    if n is None:
        return df
    keyed = df.withColumn("_key", hash_key(id_columns, seed, method))
    cut, spare, _ = smallest_keys_cut(keyed.select("_key"), "_key", int(n))
    if cut is None:
        return df.filter(F.lit(False))
    kept = keyed.filter(F.col("_key") <= cut)
    return drop_any(kept, F.col("_key") == cut, spare).drop("_key")


def random_split(
    df: DataFrame,
    id_columns: Sequence[str],
    settings: SplitSettings = SplitSettings(),
    method: str = "xxhash64",
    name: str = "split",
) -> DataFrame:
    """Add a split column: no shuffle, and a row keeps its split when the table grows."""
    at = hash_fraction(hash_key(id_columns, settings.seed, method))
    if settings.test == 0:
        later = F.lit("validation")
    else:
        later = F.when(at < settings.train + settings.validation, "validation").otherwise("test")
    return df.withColumn(name, F.when(at < settings.train, "train").otherwise(later))


def shuffled(df: DataFrame, id_columns: Sequence[str], seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """Seeded row order; a global sort, meant for exporting a training set."""
    return df.orderBy(hash_key(id_columns, seed, method), *id_columns)


def is_empty(df: DataFrame) -> bool:
    return not df.select(F.lit(1)).take(1)


def supplied_or_resplit(
    train: DataFrame,
    validation: DataFrame | None,
    test: DataFrame | None,
    id_columns: Sequence[str],
    settings: SplitSettings = SplitSettings(),
    method: str = "xxhash64",
) -> DataFrame:
    """Supplied validation and test rows if both have some, else a new split of train."""
    given = validation is not None and test is not None
    if given and not is_empty(validation) and not is_empty(test):
        parts = [("train", train), ("validation", validation), ("test", test)]
        tagged = [d.withColumn("split", F.lit(name)) for name, d in parts]
        return tagged[0].unionByName(tagged[1], True).unionByName(tagged[2], True)
    return random_split(train, id_columns, settings, method)


def class_splits(
    df: DataFrame,
    id_columns: Sequence[str],
    settings: SplitSettings = SplitSettings(0.8, 0.1, 0.1),
    has_split: bool = True,
    method: str = "xxhash64",
) -> DataFrame:
    """Keep the supplied split column if all three splits have rows, else split 80/10/10."""
    if has_split:
        if is_empty(df.filter(F.col("split") == "train")):
            raise RuntimeError("no train rows after split names were made canonical")
        if not any(is_empty(df.filter(F.col("split") == s)) for s in ("validation", "test")):
            return df.filter(F.col("split").isin("train", "validation", "test"))
    return random_split(df.drop("split"), id_columns, settings, method)


def evaluation_split(df: DataFrame, split: str = "split") -> DataFrame:
    """Test rows if there are any, else validation rows."""
    test = df.filter(F.col(split) == "test")
    return df.filter(F.col(split) == "validation") if is_empty(test) else test
