"""Session set-up for local runs, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "modspark", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture makes every column expression slow to build
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster executors could
    not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="modspark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
