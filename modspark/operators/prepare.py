"""From raw labelled rows to prepared rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions import labels as L
from modspark.functions.text import normalize, short_id


def prepare_labelled(
    df: DataFrame, text_field: str, label_fields: Sequence[str], id_field: str | None = None
) -> DataFrame:
    """Labelled rows only, as ``id?, text, labels``."""
    kept = df.filter(L.has_labels(df, label_fields))
    text = F.col(text_field) if text_field in df.columns else F.lit("")
    out = [normalize(text).alias("text"), L.label_vector(df, label_fields).alias("labels")]
    if id_field and id_field in df.columns:
        out.insert(0, F.col(id_field).alias("id"))
    return kept.select(*out)


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str:
    for name in candidates:
        if name in columns:
            return name
    raise KeyError(f"none of {list(candidates)} in columns {list(columns)}")


def prepare_three_class(df: DataFrame) -> DataFrame:
    """Three-class rows as ``id, text, labels, class_id, class_name, split, char_len``.

    Text and label columns are found by name; without a split column all rows are train.
    """
    text = first_present(df.columns, K.CLASS_TEXT_COLUMNS)
    label = first_present(df.columns, K.CLASS_LABEL_COLUMNS)
    has_split = K.CLASS_SPLIT_COLUMN in df.columns
    split = L.split_name(F.col(K.CLASS_SPLIT_COLUMN)) if has_split else F.lit("train")
    # a null text reads as the word "None" in this data format
    clean = normalize(F.coalesce(F.col(text).cast("string"), F.lit("None")))
    rows = df.select(
        clean.alias("text"), L.class_id(F.col(label)).alias("class_id"), split.alias("split")
    )
    return rows.select(
        short_id(F.col("text")).alias("id"),
        "text",
        L.multi_hot(F.col("class_id")).alias("labels"),
        "class_id",
        L.class_name(F.col("class_id")).alias("class_name"),
        "split",
        F.length("text").alias("char_len"),
    )
