"""Document quality by a generalised additive model with pairwise interactions.

A text becomes a few statistics; each is cut into bins at quantiles of the training sample.
The model is one look-up table per statistic and one per chosen pair, learned by boosting:
the statistics take turns, each time with a tree of a few leaves on its bins alone, so that
no statistic takes what another explains. Pairs are chosen by what a tree on both explains
of the rest, and are boosted the same way. A text is scored by adding its bins' entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.scores import hashed_sample, with_score
from modspark.llm.words import Words, run_hashes, word_slices

KINDS = (
    ("upper", bytes(range(65, 91))),
    ("digits", b"0123456789"),
    ("symbols", b"#*$%&|<>"),
    ("marks", b".,;:"),
    ("calls", b"!?"),
    ("other_ascii", b"\"'()+-/=@[\\]^_`{}~"),
    ("line_ends", b"\n"),
)
FEATURES = (
    *(name for name, _ in KINDS), "beyond_ascii", "log_words", "word_length", "length_spread",
    "short_words", "long_words", "distinct_words", "top_word", "echo", "repeated_runs", "words_a_line",
)


@dataclass(frozen=True)
class AdditiveFit:
    """Bounds of the training sample, chosen by a hash, and parameters of the boosting."""

    rows: int = 20_000
    bins: int = 24
    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 8
    leaves: int = 3
    rate: float = 0.2
    smooth: float = 1.0
    """Added to the curvature of a leaf, so that few rows move it little."""


def features(words: Words) -> np.ndarray:
    """One row of FEATURES per text; a text without words has zeros."""
    n = len(words.first) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(words.bounds)
    some = np.flatnonzero(size > 0)
    if not len(some):
        return out
    heads = words.bounds[:-1][some]
    for k, (_, kind) in enumerate(KINDS):
        table = np.zeros(256, np.int64)
        table[list(kind)] = 1
        out[some, k] = np.add.reduceat(table[words.data], heads) / size[some]
    at = len(KINDS)
    out[some, at] = np.add.reduceat((words.data >= 128).astype(np.int64), heads) / size[some]
    line_ends = out[:, len(KINDS) - 1] * size
    count = np.diff(words.first)
    full = np.flatnonzero(count > 0)
    if not len(full):
        return out
    first, m = words.first[:-1][full], count[full]
    length = (words.end - words.start).astype(float)
    mean = np.add.reduceat(length, first) / m
    square = np.add.reduceat(length * length, first) / m
    hashes, text = words.hashes(), words.text_of_word()
    order = np.lexsort((hashes, text))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    groups = np.flatnonzero(new)
    times = np.diff(np.append(groups, len(hashes)))
    group_text = text[order][groups]
    top = np.zeros(n)
    np.maximum.at(top, group_text, times)
    echo = np.zeros(len(hashes))
    echo[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    runs, run_at = run_hashes(hashes, words.first, 3)
    run_text = np.repeat(np.arange(n), np.diff(run_at))
    order = np.lexsort((runs, run_text))
    again = np.zeros(len(runs))
    again[1:] = (runs[order][1:] == runs[order][:-1]) & (run_text[order][1:] == run_text[order][:-1])
    columns = (
        np.log1p(m),
        mean,
        np.sqrt(np.maximum(square - mean * mean, 0)),
        np.add.reduceat((length <= 2).astype(float), first) / m,
        np.add.reduceat((length > 14).astype(float), first) / m,
        np.bincount(group_text, minlength=n)[full] / m,
        top[full] / m,
        np.add.reduceat(echo, first) / m,
        np.bincount(run_text, weights=again, minlength=n)[full] / np.diff(run_at)[full],
        m / (line_ends[full] + 1),
    )
    for k, column in enumerate(columns, at + 1):
        out[full, k] = column
    return out


@dataclass
class AdditiveModel:
    cuts: list[np.ndarray]
    base: float
    single: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        place = self.bins(x)
        total = np.full(len(x), self.base)
        for i, table in enumerate(self.single):
            total += table[place[:, i]]
        for (i, j), table in self.pairs.items():
            total += table[place[:, i], place[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def best_cut(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, int]:
    """(gain, bins left of the cut) for sums of gradients and curvatures along the last axis."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    if not len(left_g):
        return 0.0, 0
    gain = left_g**2 / (left_h + smooth) + (total_g - left_g) ** 2 / (total_h - left_h + smooth)
    gain -= total_g**2 / (total_h + smooth)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, fit: AdditiveFit) -> np.ndarray:
    """Leaf values per bin of the best tree with a few leaves, grown cut by cut."""
    leaves = [(0, len(g))]
    while len(leaves) < fit.leaves:
        found = [(*best_cut(g[a:b], h[a:b], fit.smooth), a, b) for a, b in leaves]
        gain, at, a, b = max(found)
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + fit.smooth)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """(gain, values) of the best cut of both statistics of a pair into four leaves."""
    def corners(t: np.ndarray) -> list[np.ndarray]:
        c = t.cumsum(0).cumsum(1)
        a, whole = c[:-1, :-1], c[-1, -1]
        right, below = c[:-1, -1:] - a, c[-1:, :-1] - a
        return [a, right, below, whole - a - right - below]

    gs, hs = corners(g), corners(h)
    if not gs[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(x**2 / (y + smooth) for x, y in zip(gs, hs, strict=True)) - g.sum() ** 2 / (h.sum() + smooth)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [x[i, j] / (y[i, j] + smooth) for x, y in zip(gs, hs, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), out


def trained(x: np.ndarray, y: np.ndarray, fit: AdditiveFit) -> AdditiveModel:
    """Fit the tables. With one class only, or no rows, every text scores the share of that class."""
    cuts = []
    for i in range(x.shape[1]):
        ends = np.unique(np.quantile(x[:, i], np.linspace(0, 1, fit.bins + 1)[1:-1])) if len(x) else np.zeros(0)
        cuts.append(ends)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    size = [len(c) + 1 for c in cuts]
    model = AdditiveModel(cuts, base, [np.zeros(s) for s in size], {})
    if len(np.unique(y)) < 2:
        return model
    place = model.bins(x)
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(fit.rounds):
        for i, s in enumerate(size):
            g, h = slopes()
            step = shallow_tree(np.bincount(place[:, i], g, s), np.bincount(place[:, i], h, s), fit)
            model.single[i] += fit.rate * step
            total += fit.rate * step[place[:, i]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(place[:, i] * size[j] + place[:, j], values, size[i] * size[j]).reshape(size[i], size[j])

    g, h = slopes()
    gains = [
        (quadrants(grid(i, j, g), grid(i, j, h), fit.smooth)[0], (i, j))
        for i in range(len(size))
        for j in range(i + 1, len(size))
    ]
    chosen = [pair for gain, pair in sorted(gains, reverse=True)[: fit.pairs] if gain > 0]
    model.pairs = {(i, j): np.zeros((size[i], size[j])) for i, j in chosen}
    for _ in range(fit.pair_rounds):
        for i, j in chosen:
            g, h = slopes()
            _, step = quadrants(grid(i, j, g), grid(i, j, h), fit.smooth)
            model.pairs[i, j] += fit.rate * step
            total += fit.rate * step[place[:, i], place[:, j]]
    return model


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text, in the order of the rows of docs."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [features(words) for words in word_slices(batch.column(1), lower=False)]
            x = np.vstack(parts) if parts else np.zeros((0, len(FEATURES)))
            columns = [batch.column(0), *(pa.array(x[:, k]) for k in range(len(FEATURES)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *FEATURES])

    return docs.select("doc_id", "text").mapInArrow(describe, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def fitted(docs: DataFrame, labels: DataFrame, held_out: Column, fit: AdditiveFit = AdditiveFit()) -> AdditiveModel:
    """The model from at most ``fit.rows`` labelled documents that are not held out.

    Labels without a value are passed over; of several labels of a document the highest
    counts. The sample of labels is bounded by a parameter, so it may be broadcast, and its
    rows are one task's: the driver sees the finished model alone.
    """
    truth = labels.filter(~held_out).filter("quality is not null and doc_id is not null")
    truth = truth.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = hashed_sample(truth, "doc_id", fit.rows)
    rows = described(docs.join(F.broadcast(sample.select("doc_id")), "doc_id"))
    rows = rows.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), *FEATURES).limit(fit.rows)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) for batch in batches]
        table = np.vstack([np.zeros((0, len(FEATURES) + 1)), *parts])
        model = trained(table[:, :-1], table[:, -1], fit)
        pairs = [{"i": i, "j": j, "steps": values.ravel()} for (i, j), values in model.pairs.items()]
        columns = [[model.cuts], [model.base], [model.single], [pairs]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cuts", "base", "single", "pairs"])

    lists = pa.list_(pa.list_(pa.float64()))
    pair = pa.struct([("i", pa.int32()), ("j", pa.int32()), ("steps", pa.list_(pa.float64()))])
    kinds = [lists, pa.float64(), lists, pa.list_(pair)]
    schema = "cuts array<array<double>>, base double, single array<array<double>>, pairs array<struct<i:int,j:int,steps:array<double>>>"
    row = rows.select(*FEATURES, "quality").mapInArrow(train, schema).first()
    if row is None:  # a partition without rows may not run at all
        return trained(np.zeros((0, len(FEATURES))), np.zeros(0), fit)
    cuts, single = ([np.array(x, float) for x in row[c]] for c in ("cuts", "single"))
    tables = {(p["i"], p["j"]): np.array(p["steps"]).reshape(len(single[p["i"]]), len(single[p["j"]])) for p in row["pairs"]}
    return AdditiveModel(cuts, row["base"], single, tables)


def scored(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """docs with ``score`` from 0 to 1, higher for better, for every row.

    A null or blank text has statistics of zero and gets a score like any other. Rows repeat
    as they come, equal texts score equally, whole texts count. A column named score is
    replaced, all others stay; no rows give no rows.
    """
    return with_score(docs, model, lambda known, words: known.score(features(words)), lower=False)
