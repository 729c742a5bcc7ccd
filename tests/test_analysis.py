"""Error analysis and fairness against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.constants import REFERENCE_SLICE
from modspark.functions.text import FEATURES
from modspark.operators import errors, fairness, governance
from modspark.plans import reports
from tests.test_metrics import counts, f1, pair_auc
from tests.test_text import expected_features

LABELS = ["a", "b"]
WORDS = ["Man", "tree", "girl!", "SKY", "x@y.zz", "ooo", "\"q\"", "moon"]
GROUPS = {"men": ["man"], "girls": ["girl", "girls"], "nobody": ["zebra"], "empty": []}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    texts = [" ".join(rng.choice(WORDS, rng.integers(1, 9))) for _ in range(120)]
    y = (rng.random((120, 2)) < [0.4, 0.2]).astype(int)
    p = (0.5 * rng.random((120, 2)) + 0.5 * y).astype(np.float32)
    return texts, y, p


@pytest.fixture(scope="module")
def scored(spark, data):
    rows = [(i, t, [float(v) for v in y], [float(v) for v in p]) for i, (t, y, p) in enumerate(zip(*data))]
    return spark.createDataFrame(rows, "id int, text string, labels array<double>, probs array<float>").repartition(3)


def masks(y, p, cut):
    hit = p >= np.float32(cut)
    out = {"all": np.ones(len(y), bool), "any_error": (hit != (y == 1)).any(axis=1)}
    for j, name in enumerate(LABELS):
        out[f"fp:{name}"] = (y[:, j] == 0) & hit[:, j]
        out[f"fn:{name}"] = (y[:, j] == 1) & ~hit[:, j]
    return out


@pytest.mark.parametrize("cut", [0.3, 0.999])
def test_feature_summary(scored, data, cut):
    texts, y, p = data
    got = {(r["grp"], r["feature"]): r for r in errors.feature_summary(scored, LABELS, cut).collect()}
    assert len(got) == 6 * len(FEATURES)
    rows = [expected_features(t) for t in texts]
    for grp, mask in masks(y, p, cut).items():
        for name in FEATURES:
            values = np.array([float(r[name]) for r, m in zip(rows, mask) if m])
            r = got[grp, name]
            assert r["n"] == len(values)
            if not len(values):
                assert r["mean"] is None and r["p90"] is None
                continue
            want = [values.mean(), np.median(values), np.percentile(values, 90)]
            assert [r["mean"], r["median"], r["p90"]] == pytest.approx(want, abs=1e-6)


def test_worst_cases(scored, data):
    texts, y, p = data
    got = errors.worst_cases(scored, LABELS, 0.5, k=10).collect()
    wrong = np.abs(p - y.astype(np.float32)).max(axis=1)
    order = sorted(range(len(y)), key=lambda i: (-wrong[i], i))[:10]
    for r, i in zip(got, order):
        assert r["sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()
        assert r["max_abs_error"] == pytest.approx(wrong[i])
        assert r["true_labels"] == {n: int(y[i, j]) for j, n in enumerate(LABELS)}
        assert r["pred_labels"] == {n: int(p[i, j] >= 0.5) for j, n in enumerate(LABELS)}
        assert r["pred_probs"] == {n: pytest.approx(float(p[i, j])) for j, n in enumerate(LABELS)}


def test_report_has_no_text(scored):
    for table in reports.error_report(scored, LABELS).values():
        assert "text" not in table.columns
        assert not governance.has_leak(table)


def test_slices(scored, data):
    texts, y, p = data
    words = [set(t.lower().replace("!", "").split()) for t in texts]
    members = {
        "men": np.array(["man" in w for w in words]),
        "girls": np.array(["girl" in w for w in words]),
        "nobody": np.zeros(len(words), bool),
    }
    members["any_identity_mention"] = members["men"] | members["girls"]
    members[REFERENCE_SLICE] = ~members["any_identity_mention"]
    found = reports.fairness_report(scored, GROUPS, LABELS, 0.6)
    labels = {(r["slice"], r["label"]): r for r in found["labels"].collect()}
    slices = {r["slice"]: r for r in found["slices"].collect()}
    assert set(slices) == set(members)
    rate = {}
    for name, mask in members.items():
        sums = np.zeros(3)
        for j, label in enumerate(LABELS):
            tp, fp, fn, tn = counts(y[mask, j], p[mask, j] >= np.float32(0.6))
            r = labels[name, label]
            rate[name, label] = (tp / (tp + fn) if tp + fn else 0, fp / (fp + tn) if fp + tn else 0)
            assert (r["n"], r["tp"], r["fp"], r["fn"], r["tn"]) == (mask.sum(), tp, fp, fn, tn)
            assert (r["tpr"], r["fpr"]) == pytest.approx(rate[name, label])
            auc = pair_auc(y[mask, j], p[mask, j])
            assert r["auc"] is None if auc is None else r["auc"] == pytest.approx(auc)
            sums += [tp, fp, fn]
        if mask.any():
            assert slices[name]["f1_micro"] == pytest.approx(f1(*sums))
        else:
            assert slices[name]["n"] == 0 and slices[name]["f1_micro"] is None
    gaps = {(r["slice"], r["label"]): r for r in found["label_gaps"].collect()}
    assert {s for s, _ in gaps} == {"men", "girls", "any_identity_mention"}
    for (name, label), r in gaps.items():
        ref = rate[REFERENCE_SLICE, label]
        assert r["tpr_gap"] == pytest.approx(rate[name, label][0] - ref[0])
        assert r["fpr_gap"] == pytest.approx(rate[name, label][1] - ref[1])
    assert found["metric_gaps"].count() == 3


def test_gaps_without_reference(scored):
    only = scored.filter(F.lower("text").contains("man"))
    found = reports.fairness_report(only, GROUPS, LABELS)
    assert found["label_gaps"].count() == 0 and found["metric_gaps"].count() == 0


def test_null_auc_gap(spark):
    rows = [(1, "man", [1.0], [0.9]), (2, "tree", [1.0], [0.8]), (3, "tree", [0.0], [0.1])]
    df = spark.createDataFrame(rows, "id int, text string, labels array<double>, probs array<float>")
    row = reports.fairness_report(df, {"men": ["man"]}, ["a"])["metric_gaps"].filter("slice = 'men'").first()
    assert row["auc_macro_gap"] is None and row["f1_micro_gap"] == 0.0


def test_reports_saved_from_one_scoring(spark, scored, tmp_path):
    builders = {
        "errors": lambda d: reports.error_report(d, LABELS),
        "fairness": lambda d: reports.fairness_report(d, GROUPS, LABELS),
        "thresholds": lambda d: reports.threshold_report(d, LABELS),
    }
    saved = []
    reports.save_all(scored, builders, lambda table, name: saved.append((name, table.count())))
    assert len(saved) == 10 and all(n > 0 for _, n in saved)


def test_worst_cases_are_a_top_k_without_texts(spark):
    rows = [(str(i), f"text {i}", [float(i % 2)], [i / 50]) for i in range(40)]
    frame = spark.createDataFrame(rows, "id string, text string, labels array<double>, probs array<double>")
    worst = errors.worst_cases(frame, ["y"], 0.5, 5)
    plan = worst._jdf.queryExecution().executedPlan().toString()
    top = next(line for line in plan.split("\n") if "TakeOrderedAndProject" in line)
    assert "rangepartitioning" not in plan and "text" not in top
    assert worst.count() == 5
