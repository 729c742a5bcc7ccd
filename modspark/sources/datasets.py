"""Labelled splits: reading, preparing and exporting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from modspark.config import SplitSettings
from modspark.operators.prepare import prepare_labelled
from modspark.operators.sampling import cap_rows, downsample_negatives, supplied_or_resplit

_MISSING = {"PATH_NOT_FOUND"}


CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "mode": "FAILFAST"}
"""Records as spreadsheets write them: line ends and doubled quotes inside quotes; a broken file is an error.

With line ends inside quotes a file can only be read as one piece. Where there are none, pass
``multiLine=False``: large files are then read in parts by many tasks.
"""


def read_or_none(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame | None:
    """A file or folder as a frame; None if it does not exist."""
    reader = spark.read.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {}) | options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in _MISSING:
            return None
        raise


def load_splits(
    spark: SparkSession,
    paths: Mapping[str, str],
    label_fields: Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Each split from its own path, so clashing schemas never meet.

    Missing splits are skipped. Without a train split the first one found takes its place.
    Validation and test count only if they have every label column.
    """
    found = {}
    for name, path in paths.items():
        split = read_or_none(spark, path, fmt, schema, **options)
        if split is not None:
            found[name] = split
    if not found:
        raise FileNotFoundError(f"no split found in {dict(paths)}")
    out = {"train": found.get("train", next(iter(found.values())))}
    for name in ("validation", "test"):
        if name in found and set(label_fields) <= set(found[name].columns):
            out[name] = found[name]
    return out


def load_prepared(
    splits: Mapping[str, DataFrame],
    text_field: str,
    label_fields: Sequence[str],
    id_field: str,
    negative_ratio: float = 1.0,
    settings: SplitSettings = SplitSettings(),
    method: str = "xxhash64",
) -> DataFrame:
    """Prepared rows with a split column.

    Train is down-sampled first, so validation and test cut from it are, too.
    """
    ready = {k: prepare_labelled(d, text_field, label_fields, id_field) for k, d in splits.items()}
    train = downsample_negatives(ready["train"], negative_ratio, ["id"], settings.seed, method=method)
    return supplied_or_resplit(
        train, ready.get("validation"), ready.get("test"), ["id"], settings, method
    )


def export_splits(
    df: DataFrame,
    path: str,
    splits: Sequence[str] = ("train", "validation", "test"),
    max_rows: int | None = None,
    id_columns: Sequence[str] = ("id",),
    mode: str = "errorifexists",
    method: str = "xxhash64",
) -> None:
    """Write rows partitioned by split, so reading one split reads only its files."""
    if max_rows is None:
        df.write.mode(mode).partitionBy("split").parquet(path)
        return
    parts = [cap_rows(df.filter(df["split"] == s), max_rows, id_columns, method=method) for s in splits]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out.write.mode(mode).partitionBy("split").parquet(path)
