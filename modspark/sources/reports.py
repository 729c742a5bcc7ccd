"""Report sinks and the artefact registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.operators.governance import latest_artifacts


def save_report(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report table as JSON lines, one object per row."""
    line = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    table.select(line.alias("value")).write.mode(mode).text(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``kind, run_name, payload`` from files named ``<path>/<kind>/<run name>.json``."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return files.select(
        F.element_at(parts, -2).alias("kind"),
        F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("run_name"),
        F.col("value").alias("payload"),
    )


def newest_reports(spark: SparkSession, path: str, kinds: Sequence[str]) -> DataFrame:
    return latest_artifacts(read_runs(spark, path), kinds)
