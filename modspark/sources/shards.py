"""A training set in seeded order as a fixed number of files, without a global sort.

The order is that of ``sampling.shuffled``. A histogram of the order keys gives the cuts, so a
shard is a range of keys and knows its rows without seeing others; only a shard is
ever sorted. A manifest row per finished shard makes the export restartable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark.operators.order_stats import KEY_BITS
from modspark.operators.sampling import hash_key
from modspark.sources.datasets import read_or_none

CELL_BITS = 20
MANIFEST = "shard int, rows long, first_key long, last_key long, checksum long, cuts string"


def shard_cuts(keys: DataFrame, key: str, shards: int) -> list[int]:
    """First cell of every shard but the first: cuts of a histogram into nearly equal parts.

    The histogram has at most 2^20 rows whatever the data; the driver sees one row per shard.
    """
    cell = F.shiftright(F.col(key), KEY_BITS - CELL_BITS).alias("cell")
    histogram = keys.groupBy(cell).agg(F.count("*").alias("n"))
    run = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.select("cell", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    shard = F.floor(F.col("before") * shards / F.col("all")).cast("int").alias("shard")
    first = {r["shard"]: r["cell"] for r in placed.groupBy(shard).agg(F.min("cell").alias("cell")).collect()}
    # a shard that no cell begins in is empty: it begins where the next one does
    cuts, after = [], 1 << CELL_BITS
    for k in range(shards - 1, 0, -1):
        after = first.get(k, after)
        cuts.append(after)
    return cuts[::-1]


def _shard(key: Column, cuts: Sequence[int]) -> Column:
    """How many cuts lie at or below a key's cell, by halving the list of cuts."""
    cell = F.shiftright(key, KEY_BITS - CELL_BITS)

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(cell < cuts[middle], below(low, middle)).otherwise(below(middle + 1, high))

    return below(0, len(cuts))


def export_shards(
    df: DataFrame, id_columns: Sequence[str], path: str, shards: int, seed: int = 42, method: str = "xxhash64", waves: int = 1
) -> DataFrame:
    """Write ``path/rows`` in shards and return the manifest: ``shard, rows, first_key, last_key, checksum``.

    Rows of a shard are in order; shards follow each other. The checksum of a shard is the
    sum of hashes of its rows, whatever their order. With several ``waves`` the shards are written in
    parts, each with its manifest rows: an export that was ended goes on with the shards it
    has not finished, if the rows have not changed. An empty table has an empty manifest.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", hash_key(id_columns, seed, method))
    cuts = shard_cuts(keyed.select("_key"), "_key", shards)
    named = ",".join(map(str, cuts))
    old = read_or_none(spark, f"{path}/manifest", "parquet")
    done = {r["shard"] for r in old.filter(F.col("cuts") == named).select("shard").collect()} if old is not None else set()
    parts = keyed.withColumn("shard", _shard(F.col("_key"), cuts))
    left = [k for k in range(shards) if k not in done]
    size = -(-len(left) // max(1, waves)) if left else 1
    for first in range(0, len(left), size):
        chosen = left[first : first + size]
        rows = parts.filter(F.col("shard").isin(chosen)) if len(chosen) < shards else parts
        ordered = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "_key", *id_columns)
        # a shard that was written without its manifest row is written anew
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{path}/rows")
        _measured(spark.read.schema(parts.schema).parquet(f"{path}/rows").filter(F.col("shard").isin(chosen)), df.columns, named).write.mode("append").parquet(f"{path}/manifest")
    found = spark.read.schema(MANIFEST).parquet(f"{path}/manifest") if shards and (left or done) else spark.createDataFrame([], MANIFEST)
    return found.filter(F.col("cuts") == named).drop("cuts")


def _measured(rows: DataFrame, columns: Sequence[str], cuts: str) -> DataFrame:
    checksum = F.sum(F.xxhash64(F.to_json(F.struct(*columns))).cast("decimal(38,0)"))
    return rows.groupBy("shard").agg(
        F.count("*").alias("rows"), F.min("_key").alias("first_key"), F.max("_key").alias("last_key"),
        F.pmod(checksum, F.lit(1 << 62).cast("decimal(38,0)")).cast("long").alias("checksum"),
    ).withColumn("cuts", F.lit(cuts)).select(F.col("shard").cast("int").alias("shard"), "rows", "first_key", "last_key", "checksum", "cuts")


def shards_with(rows: DataFrame, manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``shard, intact``: whether the rows that are stored still give the manifest's figures."""
    now = _measured(rows, columns, "").select("shard", F.col("rows").alias("_rows"), F.col("checksum").alias("_checksum"))
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("checksum").eqNullSafe(F.col("_checksum"))
    return manifest.join(now, "shard", "left").select("shard", same.alias("intact"))


def positions(rows: DataFrame, manifest: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """The stored rows with ``position``: their place in the whole order, from 0."""
    before = F.coalesce(F.sum("rows").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = manifest.select(F.col("shard").alias("_shard"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard").orderBy("_key", *id_columns)) - 1
    placed = rows.withColumn("_inside", inside).join(F.broadcast(offsets), F.col("shard") == F.col("_shard"))
    return placed.withColumn("position", F.col("_before") + F.col("_inside")).drop("_inside", "_before", "_shard", "_key")
