"""Penalised logistic regressions of many columns, by a trust-region Newton method in shared passes.

The objective of a column is C times the weighted log loss plus half the squared weights, the
intercept among them: it is the weight of one more feature that is 1 everywhere. Rows are
kept as blocks of sparse rows. Every step is one pass over them that serves all columns still
at work, whatever label or setting they belong to: losses and slopes at a point, or the curvature along
a direction. Partial sums are added by ranges of features, so no task or driver ever holds more
than a few times features x columns numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

BLOCK = 1 << 18
"""Non-zero cells of a block, about."""


@dataclass(frozen=True)
class Column:
    """What one column learns: the label's place, and the settings of its objective."""

    label: int
    c: float = 4.0
    positive: float = 1.0
    """Weight of the rows that have the label."""


@dataclass
class Block:
    """Some rows: their non-zero cells, and their labels."""

    n: int
    owner: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    target: np.ndarray

    @cached_property
    def places(self) -> np.ndarray:
        """Features as numpy's own index type, turned once for all columns of a pass."""
        return self.feature.astype(np.intp)

    @cached_property
    def owners(self) -> np.ndarray:
        return self.owner.astype(np.intp)

    @cached_property
    def heads(self) -> np.ndarray:
        """Where the cells of every row that has some begin."""
        return np.flatnonzero(np.concatenate(([True], self.owner[1:] != self.owner[:-1]))) if len(self.owner) else self.places

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Rows x columns: features times weights (columns x features, the intercept last)."""
        out = np.zeros((self.n, len(weights)))
        own = self.owners[self.heads]
        for k, w in enumerate(weights):
            if len(own):
                out[own, k] = np.add.reduceat(self.value * w.take(self.places), self.heads)
            out[:, k] += w[-1]
        return out

    def add_back(self, rows: np.ndarray, into: np.ndarray, power: int = 1) -> None:
        """Add (powers of) features x rows to ``into`` (columns x features)."""
        size, value = into.shape[1], self.value**power
        for k in range(len(into)):
            into[k] += np.bincount(self.places, value * np.ascontiguousarray(rows[:, k]).take(self.owners), size)
            into[k, -1] += rows[:, k].sum()


SCHEMA = "n int, owner binary, feature binary, value binary, target binary"


def blocks(rows: DataFrame, features: str, labels: str, width: int) -> DataFrame:
    """Blocks of rows(features vector, labels array<double>).

    The first ``width`` labels count, as given above 0; a missing or null one is not given.
    """
    given = F.array(*[F.coalesce(F.get(F.col(labels), F.lit(i)), F.lit(0.0)).cast("double") for i in range(width)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0)
            kind, index, value = (vectors.field(name) for name in ("type", "indices", "values"))
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size, first = 0, 0
            for i in range(batch.num_rows):
                v = value[i].values.to_numpy(zero_copy_only=False)
                at = np.arange(len(v)) if kind[i].as_py() == 1 else index[i].values.to_numpy(zero_copy_only=False)
                held.append((at, v))
                size += len(v)
                if size >= BLOCK or i == batch.num_rows - 1:
                    target = np.array(batch.column(1).slice(first, len(held)).to_pylist(), float)
                    owner = np.repeat(np.arange(len(held), dtype=np.int32), [len(a) for a, _ in held])
                    parts = [owner, np.concatenate([a for a, _ in held]).astype(np.int32), np.concatenate([x for _, x in held]), target]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(held)], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)],
                        names=["n", "owner", "feature", "value", "target"],
                    )
                    held, size, first = [], 0, i + 1

    return rows.select(F.unwrap_udt(features).alias("v"), given.alias("labels")).mapInArrow(pack, SCHEMA)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        yield from map(_block, batch.to_pylist())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Data:
    """Blocks as tasks keep them between the passes, which differ in the weights alone.

    A pass is a fold over each task's blocks and a sum by ranges of features. It is one small job of
    many, so it goes without a query plan of its own.
    """

    blocks: RDD[Block]
    rows: int

    @staticmethod
    def of(packed: DataFrame) -> Data:
        kept = packed.rdd.mapPartitions(lambda rows: map(_block, rows)).persist(StorageLevel.MEMORY_AND_DISK)
        return Data(kept, kept.map(lambda b: b.n).sum())

    def close(self) -> None:
        self.blocks.unpersist()

    def summed(self, shape: tuple[int, int], sent: object, partial: Callable[[Block, np.ndarray, object], None]) -> np.ndarray:
        """The sum over all blocks of what ``partial(block, into, sent)`` adds to an array of this shape."""
        parts = max(1, self.blocks.getNumPartitions())
        ranges = max(1, min(parts, 64, self.blocks.context.defaultParallelism))
        cuts = np.linspace(0, shape[1], ranges + 1).astype(int)
        known = self.blocks.context.broadcast(sent)

        def sweep(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            total = None
            for block in blocks:
                total = np.zeros(shape) if total is None else total
                partial(block, total, known.value)
            if total is not None:
                yield from ((r, total[:, a:b]) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))

        try:
            found = self.blocks.mapPartitions(sweep).reduceByKey(np.add, ranges).collect()
        finally:
            known.destroy()
        out = np.zeros(shape)
        for r, part in found:
            out[:, cuts[r] : cuts[r + 1]] = part
        return out


def _block(row: Row | dict) -> Block:
    target = np.frombuffer(row["target"], np.float64).reshape(row["n"], -1)
    return Block(row["n"], *(np.frombuffer(row[c], kind) for c, kind in (("owner", np.int32), ("feature", np.int32), ("value", np.float64))), target)


def _signs(block: Block, columns: Sequence[Column]) -> tuple[np.ndarray, np.ndarray]:
    """(is given, weight), rows x columns."""
    given = block.target[:, [c.label for c in columns]] > 0
    return given, np.where(given, [c.positive for c in columns], 1.0)


@dataclass(frozen=True)
class Sums:
    """What a pass finds for a column: objective, slope and own curvatures at its weights."""

    loss: float
    slope: np.ndarray
    own: np.ndarray


def swept(
    data: Data, columns: Sequence[Column], weights: np.ndarray, along: Sequence[np.ndarray | None]
) -> list[Sums | np.ndarray]:
    """One pass: for a column with a direction, the second derivative of its objective at its
    weights times that direction; for one without, the objective, its slope and own curvatures."""
    size = weights.shape[1]
    curved = [k for k, v in enumerate(along) if v is not None]
    plain = [k for k, v in enumerate(along) if v is None]
    c, p = len(curved), len(plain)
    directions = np.array([along[k] for k in curved]).reshape(c, size)

    def partial(block: Block, into: np.ndarray, sent: tuple[np.ndarray, np.ndarray]) -> None:
        w, v = sent
        given, weight = _signs(block, columns)
        margin = block.margins(w)
        chance = sigmoid(margin)
        bent = weight * chance * (1 - chance)
        if c:
            block.add_back(bent[:, curved] * block.margins(v), into[:c, :size])
        if p:
            block.add_back((weight * (chance - given))[:, plain], into[c : c + p, :size])
            block.add_back(bent[:, plain], into[c + p :, :size], 2)
            into[c : c + p, -1] += (weight * np.logaddexp(0, np.where(given, -margin, margin))).sum(axis=0)[plain]

    found = data.summed((c + 2 * p, size + 1), (weights, directions), partial)
    out: list = [None] * len(columns)
    for row, k in enumerate(curved):
        out[k] = columns[k].c * found[row, :size] + along[k]
    for row, k in enumerate(plain, c):
        w, rate = weights[k], columns[k].c
        loss = rate * found[row, -1] + 0.5 * (w @ w)
        out[k] = Sums(float(loss), rate * found[row, :size] + w, rate * found[row + p, :size] + 1.0)
    return out


def losses_and_slopes(
    data: Data, columns: Sequence[Column], weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Objective, slope and own curvature of every weight, for every column at its weights."""
    found = swept(data, columns, weights, [None] * len(columns))
    return np.array([x.loss for x in found]), np.array([x.slope for x in found]), np.array([x.own for x in found])


def curvatures(data: Data, columns: Sequence[Column], weights: np.ndarray, along: np.ndarray) -> np.ndarray:
    """The second derivative of every column's objective times a direction of its own."""
    return np.array(swept(data, columns, weights, list(along)))


@dataclass
class _Search:
    """Where a column stands: its point, and the conjugate gradients inside its trust region.

    Steps are measured by the weights' own curvatures, so a weight of a rare feature moves as
    freely as that of a common one.
    """

    weights: np.ndarray
    loss: float
    slope: np.ndarray
    own: np.ndarray
    radius: float = np.inf
    step: np.ndarray = field(init=False)
    residual: np.ndarray = field(init=False)
    along: np.ndarray = field(init=False)
    first: float = field(init=False)

    def size(self, step: np.ndarray) -> float:
        return float(np.sqrt((self.own * step) @ step))

    def open(self) -> None:
        self.step = np.zeros_like(self.weights)
        self.residual = -self.slope
        self.along = self.residual / self.own
        self.first = self.residual @ self.along
        if not np.isfinite(self.radius):
            self.radius = max(1.0, self.size(self.along))

    def advance(self, curved: np.ndarray, share: float) -> bool:
        """One step of conjugate gradients; whether the inner search is over."""
        before = self.residual @ (self.residual / self.own)
        alpha = before / max(self.along @ curved, 1e-300)
        further = self.step + alpha * self.along
        if self.size(further) >= self.radius:
            # to the edge of the region
            dd, sd, ss = self.size(self.along) ** 2, (self.own * self.step) @ self.along, self.size(self.step) ** 2
            alpha = (-sd + np.sqrt(max(sd * sd + dd * (self.radius**2 - ss), 0.0))) / dd
            self.step = self.step + alpha * self.along
            self.residual = self.residual - alpha * curved
            return True
        self.step = further
        self.residual = self.residual - alpha * curved
        left = self.residual / self.own
        after = self.residual @ left
        self.along = left + (after / before) * self.along
        return bool(after <= share**2 * self.first)

    def predicted(self) -> float:
        """How much the quadratic model falls along the step."""
        return float(0.5 * (self.step @ (self.residual - self.slope)))

    def settle(self, loss: float, slope: np.ndarray, own: np.ndarray) -> None:
        """Take the step if the objective falls, and fit the region to how well it was foretold."""
        fell, foretold = self.loss - loss, self.predicted()
        ratio = fell / foretold if foretold > 0 else 0.0
        size = self.size(self.step)
        if ratio < 0.25:
            self.radius = 0.25 * size
        elif ratio > 0.75:
            self.radius = max(self.radius, 3.0 * size)
        if ratio > 1e-4 or (fell >= 0 and foretold <= 1e-12 * abs(self.loss)):
            self.weights, self.loss, self.slope, self.own = self.weights + self.step, loss, slope, own


def minimised(
    data: Data, features: int, columns: Sequence[Column], max_iter: int = 200, tolerance: float = 1e-5, inner: int = 60
) -> np.ndarray:
    """Weights that minimise every column's objective: columns x (features + 1), the intercept last.

    A column is done when no slope of its objective over C times the rows exceeds
    ``tolerance``, or after ``max_iter`` outer steps. The driver holds a few vectors a column.
    """
    n = max(1, data.rows)
    start = np.zeros((len(columns), features + 1))
    state = [_Search(start[k], x.loss, x.slope, x.own) for k, x in enumerate(swept(data, columns, start, [None] * len(columns)))]
    steep = [max(np.abs(x.slope).max(), 1e-300) for x in state]
    outer, steps = [0] * len(columns), [0] * len(columns)
    share = [0.5] * len(columns)
    searching: set[int] = set()

    def opened(k: int) -> bool:
        """Begin the next search of a column, unless it is done."""
        steepest = np.abs(state[k].slope).max()
        if outer[k] >= max_iter or steepest <= tolerance * columns[k].c * n or state[k].radius <= 1e-12:
            return False
        state[k].open()
        # rough at first, closer as the slope falls
        share[k] = min(0.5, max(0.1, np.sqrt(steepest / steep[k])))
        steps[k] = 0
        searching.add(k)
        return True

    work = [k for k in range(len(columns)) if opened(k)]
    while work:
        # every column goes at its own pace: some look at a new point while others still search
        points = np.array([state[k].weights if k in searching else state[k].weights + state[k].step for k in work])
        along = [state[k].along if k in searching else None for k in work]
        done = []
        for k, found in zip(work, swept(data, [columns[k] for k in work], points, along), strict=True):
            if k in searching:
                steps[k] += 1
                if state[k].advance(found, share[k]) or steps[k] >= inner:
                    searching.discard(k)
                continue
            state[k].settle(found.loss, found.slope, found.own)
            outer[k] += 1
            if not opened(k):
                done.append(k)
        work = [k for k in work if k not in done]
    return np.array([s.weights for s in state])


def probabilities(data: DataFrame, weights: np.ndarray, sets: int) -> DataFrame:
    """trial, labels, probs for all rows of the blocks and each of ``sets`` equal groups of columns."""
    sent = data.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in unpacked(batches):
            p = sigmoid(block.margins(sent.value)).astype(np.float32).reshape(block.n, sets, -1)
            for k in range(sets):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * block.n, pa.int32()),
                        pa.array(block.target.tolist(), pa.list_(pa.float64())),
                        pa.array(p[:, k].tolist(), pa.list_(pa.float32())),
                    ],
                    names=["trial", "labels", "probs"],
                )

    return data.mapInArrow(score, "trial int, labels array<double>, probs array<float>")
