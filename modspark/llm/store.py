"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir; a local one only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="modspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def saved(frame: DataFrame) -> DataFrame:
    """Write the frame as a table and read it back: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
