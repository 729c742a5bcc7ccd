"""Scorers: batched probabilities per label, evaluated only where they are needed."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.functions.labels import rekey
from modspark.functions.numbers import computed_once

Predict = Callable[[list[str]], np.ndarray]


class Scorer:
    """Adds ``array<float>`` scores, one per label, to a frame of texts.

    ``where`` limits the work: rows that fail it get null and never reach the model.
    """

    name: str
    labels: Sequence[str]

    def score(self, df: DataFrame, text: str, out: str, where: Column | None = None) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class ExpressionScorer(Scorer):
    """Scores given by a native column expression of the text."""

    name: str
    labels: Sequence[str]
    expression: Callable[[Column], Column]

    def score(self, df, text, out, where=None):
        scores = self.expression(F.coalesce(F.col(text), F.lit(""))).cast("array<float>")
        return df.withColumn(out, computed_once(scores if where is None else F.when(where, scores)))


@dataclass(frozen=True)
class ColumnScorer(Scorer):
    """Scores that a table holds already, as an array in label order."""

    name: str
    labels: Sequence[str]
    column: str

    def score(self, df, text, out, where=None):
        scores = F.col(self.column).cast("array<float>")
        return df.withColumn(out, scores if where is None else F.when(where, scores))


@dataclass(frozen=True)
class MapScorer(Scorer):
    """Wraps an expression that yields a map of scores under the model's own label names."""

    name: str
    labels: Sequence[str]
    expression: Callable[[Column], Column]
    renames: dict[str, str]

    def score(self, df, text, out, where=None):
        found = self.expression(F.coalesce(F.col(text), F.lit("")))
        scores = rekey(found, self.labels, self.renames)
        return df.withColumn(out, computed_once(scores if where is None else F.when(where, scores)))


@dataclass(frozen=True)
class BatchScorer(Scorer):
    """Scores from a Python model, over Arrow batches.

    ``load`` runs once per worker task and returns a function from a list of texts to an
    N x L matrix. The column is marked non-deterministic so that Spark neither repeats it
    nor moves filters through it: each text is scored once.

    A model pads the texts of a batch to the longest. Of every ``reorder`` texts those of like
    length make a batch, and scores go back to their places; 0 keeps texts in their order.
    """

    name: str
    labels: Sequence[str]
    load: Callable[[], Predict]
    batch_size: int = 64
    reorder: int = 4096

    def score(self, df, text, out, where=None):
        load, width, size, reorder = self.load, len(self.labels), max(self.batch_size, 1), self.reorder

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            predict = load()
            for batch in batches:
                yield _score_batch(predict, batch, width, size, reorder)

        wanted = F.coalesce(F.col(text), F.lit(""))
        if where is not None:
            wanted = F.when(where, wanted)
        return df.withColumn(out, run.asNondeterministic()(wanted))


def batch_places(lengths: np.ndarray, size: int, reorder: int) -> Iterator[np.ndarray]:
    """Which texts make a batch: like lengths together, inside every ``reorder`` texts."""
    window = reorder if reorder > 0 else max(1, len(lengths))
    for first in range(0, len(lengths), window):
        order = np.arange(first, min(first + window, len(lengths)))
        if reorder > 0:
            order = order[np.argsort(lengths[order], kind="stable")]
        for start in range(0, len(order), size):
            yield order[start : start + size]


def _score_batch(predict: Predict, batch: pd.Series, width: int, size: int, reorder: int) -> pd.Series:
    """Scores of the non-null texts of a batch, null elsewhere."""
    scores: list[np.ndarray | None] = [None] * len(batch)
    places = np.flatnonzero(batch.notna().to_numpy())
    texts = batch.iloc[places].tolist()
    lengths = np.array([len(t) for t in texts], int)
    for chosen in batch_places(lengths, size, reorder):
        matrix = np.asarray(predict([texts[i] for i in chosen]), dtype=np.float32)
        if matrix.shape != (len(chosen), width):
            raise ValueError(f"scorer returned shape {matrix.shape}, expected {(len(chosen), width)}")
        for place, row in zip(places[chosen], matrix):
            scores[place] = row
    return pd.Series(scores, index=batch.index, dtype=object)


def constant_scorer(name: str, labels: Sequence[str], values: Sequence[float]) -> ExpressionScorer:
    """The same scores for every text, padded with zeros; for rule tests."""
    padded = [*values, *[0.0] * (len(labels) - len(values))]
    return ExpressionScorer(name, labels, lambda _: F.array(*[F.lit(float(v)) for v in padded]))
