"""Moderation requests: one text or a batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_texts(requests: DataFrame) -> DataFrame:
    """One row per text as ``..., pos, text``; a batch wins over a single text, neither gives none."""
    single = F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(F.array("text"))
    kept = [c for c in requests.columns if c not in ("text", "texts")]
    return requests.select(*kept, F.posexplode(F.coalesce("texts", single)).alias("pos", "text"))
