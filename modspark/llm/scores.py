"""Scores of whole texts by a small model that every task holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from modspark.llm.words import Words, word_slices


HASHES = 1 << 31


def hashed_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hashes of the key.

    Rows far beyond the bound are filtered out by their hash first, so the final order
    sees a few times the bound, however many partitions there are.
    """
    order = F.pmod(F.xxhash64(key), F.lit(HASHES))
    share = min(1.0, 4 * bound / max(1, rows.count()))
    return rows.filter(order < F.lit(int(HASHES * share))).orderBy(order, key).limit(bound)


def with_score(docs: DataFrame, model: Any, score: Callable[[Any, Words], np.ndarray], lower: bool) -> DataFrame:
    """docs with a column ``score`` from the words of ``text``; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")
    at = kept.columns.index("text")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [score(shared.value, words) for words in word_slices(batch.column(at), lower=lower)]
            found = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(add, schema)
