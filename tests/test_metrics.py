"""Metrics against brute force on random frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.constants import THRESHOLD_GRID
from modspark.operators import metrics, thresholds

LABELS = ["a", "b", "c"]


def frame(spark, y, p, labels=LABELS):
    rows = [(list(map(float, yi)), [float(v) for v in pi]) for yi, pi in zip(y, p)]
    df = spark.createDataFrame(rows, "labels array<double>, probs array<float>")
    return metrics.to_long(df, labels)


def pair_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def f1(tp, fp, fn):
    return 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0


def counts(y, hit):
    return ((y == 1) & hit).sum(), ((y == 0) & hit).sum(), ((y == 1) & ~hit).sum(), ((y == 0) & ~hit).sum()


def samples(seed, n=300):
    rng = np.random.default_rng(seed)
    y = (rng.random((n, 3)) < [0.5, 0.1, 0.0]).astype(int)
    p = (0.6 * rng.random((n, 3)) + 0.4 * y).astype(np.float32)
    p[: n // 3] = np.round(p[: n // 3], 1)  # ties, on grid points too
    p[: n // 6] = np.float32(rng.choice(THRESHOLD_GRID, (n // 6, 3)))
    p[-5:] *= np.float32(1e-30)
    p[-2:] = 0
    return y, p


@pytest.mark.parametrize("seed", [1, 2])
def test_evaluation(spark, seed):
    y, p = samples(seed)
    per = metrics.evaluate_labels(frame(spark, y, p), threshold=0.35)
    got = {r["label"]: r for r in per.collect()}
    f1s, sums, aucs = [], np.zeros(3), []
    for j, name in enumerate(LABELS):
        tp, fp, fn, tn = counts(y[:, j], p[:, j] >= np.float32(0.35))
        r = got[name]
        assert (r["tp"], r["fp"], r["fn"], r["tn"], r["n"], r["positives"]) == (tp, fp, fn, tn, len(y), tp + fn)
        auc = pair_auc(y[:, j], p[:, j])
        assert r["auc"] is None if auc is None else r["auc"] == pytest.approx(auc, abs=1e-12)
        f1s.append(f1(tp, fp, fn))
        sums += [tp, fp, fn]
        aucs += [] if auc is None else [auc]
    row = metrics.summarize(per).first()
    assert row["f1_micro"] == pytest.approx(f1(*sums))
    assert row["f1_macro"] == pytest.approx(np.mean(f1s))
    assert row["auc_macro"] == pytest.approx(np.mean(aucs))
    plain = metrics.f1_scores(metrics.confusion(frame(spark, y, p), threshold=0.35)).first()
    assert plain["f1_micro"] == pytest.approx(row["f1_micro"])


def test_auc_corner_cases(spark):
    y = np.array([[1, 1, 0], [0, 1, 1], [0, 1, 0], [1, 1, 1]])
    p = np.full((4, 3), 0.5, dtype=np.float32)
    p[0, 2] = np.nan
    got = {r["label"]: r["auc"] for r in metrics.evaluate_labels(frame(spark, y, p)).collect()}
    assert got == {"a": 0.5, "b": None, "c": None}
    assert metrics.summarize(metrics.evaluate_labels(frame(spark, y[:, 1:2], p[:, 1:2], ["b"]))).first()["auc_macro"] is None


def test_one_label_stays_multilabel(spark):
    y = np.array([[1], [0], [0], [1]])
    p = np.array([[0.9], [0.8], [0.1], [0.2]])
    row = metrics.summarize(metrics.evaluate_labels(frame(spark, y, p, ["a"]))).first()
    assert row["f1_micro"] == pytest.approx(f1(1, 1, 1))


@pytest.mark.parametrize("seed", [3, 4])
def test_threshold_search(spark, seed):
    y, p = samples(seed)
    table = thresholds.grid_counts(frame(spark, y, p))
    got = {r["label"]: (r["threshold"], r["f1"]) for r in thresholds.best_per_label(table).collect()}
    per_cut = []
    for t in THRESHOLD_GRID:
        hit = p >= np.float32(t)
        per_cut.append([counts(y[:, j], hit[:, j])[:3] for j in range(3)])
    for j, name in enumerate(LABELS):
        scores = [f1(*c[j]) for c in per_cut]
        best = int(np.argmax(scores))
        assert got[name] == (THRESHOLD_GRID[best], pytest.approx(scores[best]))
    assert got["c"] == (0.05, 0.0)  # no positives
    micro = [f1(*np.sum(c, axis=0)) for c in per_cut]
    best = int(np.argmax(micro))
    row = thresholds.best_global(table).first()
    assert row["threshold"] == THRESHOLD_GRID[best]
    assert row["f1_micro"] == pytest.approx(micro[best])
    assert row["f1_macro"] == pytest.approx(np.mean([f1(*c) for c in per_cut[best]]))


def test_apply_thresholds(spark):
    long = frame(spark, [[1, 0, 1]], [[0.4, 0.4, 0.4]])
    cuts = spark.createDataFrame([("a", 0.4), ("b", 0.45), ("c", 0.1)], "label string, threshold double")
    got = {r["label"]: r["pred"] for r in thresholds.apply_thresholds(long, cuts).collect()}
    assert got == {"a": 1, "b": 0, "c": 1}
    one = spark.createDataFrame([(0.5,)], "threshold double")
    assert thresholds.apply_thresholds(long, one, on=()).agg(F.sum("pred")).first()[0] == 0


def test_compare_models(spark):
    y, p = samples(9, 60)
    long = frame(spark, y, p).withColumn("model", F.lit("x"))
    listed = spark.createDataFrame([("x",), ("y",)], "model string")
    got = {r["model"]: r for r in metrics.compare_models(long, listed).collect()}
    assert got["x"]["n"] == 60 and got["x"]["note"] == ""
    assert got["y"]["f1_micro"] is None and got["y"]["note"] == "no predictions"


def test_weights_and_prevalence(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([1.0, 0.0],), ([0.0, 0.0],)], "labels array<double>")
    got = {r["label"]: r["pos_weight"] for r in metrics.positive_weights(df, ["a", "b"]).collect()}
    assert got == {"a": pytest.approx(2 / 3), "b": 4.0}
    wide = {r["label"]: r["pos_weight"] for r in metrics.positive_weights(df, LABELS).collect()}
    assert set(wide.values()) == {1.0}
    rates = {r["label"]: r["positive_rate"] for r in metrics.label_prevalence(df, ["a", "b"]).collect()}
    assert rates == {"a": pytest.approx(2 / 3), "b": 0.0}
