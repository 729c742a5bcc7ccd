import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.operators import tfidf

TEXTS = ["Bad bad words here", "good words, x y here", "bad ideas are bad", "all good", "école_1 bad école_1", ""] * 4
LABELS = [[1.0, 0.0], [0.0, 0.0], [1.0, 0.0], [0.0, 0.0], [1.0, 0.0], [0.0, 0.0]] * 4


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, y) for i, (t, y) in enumerate(zip(TEXTS, LABELS))]
    return spark.createDataFrame(data, "id int, text string, labels array<double>").repartition(2)


def terms(text):
    words = re.findall(r"\b\w\w+\b", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_features(rows):
    """Smoothed idf plus one, unit length."""
    stages = tfidf.fit_features(rows, "text", tfidf.TfidfSettings())
    vocabulary = next(s for s in stages if hasattr(s, "vocabulary")).vocabulary
    counts = [Counter(terms(t)) for t in TEXTS]
    assert set(vocabulary) == set().union(*counts)
    found = tfidf._through(stages, rows.select("id", F.col("text").alias(tfidf._TEXT)))
    for r in found.select("id", tfidf._FEATURES).collect():
        count = counts[r["id"]]
        want = np.array([
            count[w] * (math.log((1 + len(TEXTS)) / (1 + sum(w in c for c in counts))) + 1) for w in vocabulary
        ])
        norm = np.linalg.norm(want)
        np.testing.assert_allclose(r[tfidf._FEATURES].toArray(), want / norm if norm else want, atol=1e-12)


def test_max_features(rows):
    stages = tfidf.fit_features(rows, "text", tfidf.TfidfSettings(max_features=3, ngram_range=(1, 1)))
    vocabulary = next(s for s in stages if hasattr(s, "vocabulary")).vocabulary
    assert len(vocabulary) == 3 and vocabulary[0] == "bad"


def test_classifier(spark, rows, tmp_path):
    """Separates the classes, agrees with the stated objective, survives saving."""
    settings = tfidf.TfidfSettings(max_iter=100)
    model = tfidf.train_tfidf_lr(rows, ["toxic", "never"], settings)
    scored = model.score(rows, "text", "probs").collect()
    for r in scored:
        if r["text"]:
            assert (r["probs"][0] > 0.5) == (r["labels"][0] > 0), r["text"]
        assert r["probs"][1] < 1e-6  # a label without positives
    lr = [s for s in model.stages.stages if hasattr(s, "coefficients")][0]
    features = tfidf._through(model.stages.stages[:-2], rows.select("labels", F.col("text").alias(tfidf._TEXT)))
    data = [(r["labels"][0], r[tfidf._FEATURES].toArray()) for r in features.select("labels", tfidf._FEATURES).collect()]
    y, x = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    w, b = lr.coefficients.toArray(), lr.intercept
    residual = 1 / (1 + np.exp(-(x @ w + b))) - y
    gradient = settings.c * x.T @ residual + w  # of 0.5 |w|^2 + C * loss
    # the intercept is penalised like a weight
    assert np.abs(gradient).max() < 1e-3 and abs(settings.c * residual.sum() + b) < 1e-3
    path = str(tmp_path / "model")
    model.save(path)
    loaded = tfidf.TfidfModel.load(path)
    assert list(loaded.labels) == ["toxic", "never"]
    again = {r["id"]: r["probs"] for r in loaded.score(rows, "text", "probs").collect()}
    assert again == {r["id"]: r["probs"] for r in scored}
    some = loaded.score(rows, "text", "probs", where=F.col("id") < 3).collect()
    assert all((r["probs"] is not None) == (r["id"] < 3) for r in some)


def test_pos_weight_raises_scores(rows):
    rare = rows.withColumn("labels", F.array(F.when(F.col("id") == 0, 1.0).otherwise(0.0)))
    plain = tfidf.train_tfidf_lr(rare, ["a"], tfidf.TfidfSettings(max_iter=20))
    heavy = tfidf.train_tfidf_lr(rare, ["a"], tfidf.TfidfSettings(max_iter=20, use_pos_weight=True))
    def mean(m):
        return m.score(rare, "text", "p").agg(F.avg(F.get("p", F.lit(0)))).first()[0]

    assert mean(heavy) > mean(plain)


def test_tuning(spark, rows):
    grid = {"c": [0.001, 4.0], "max_iter": [10], "ngram_range": [(1, 1), (1, 2)]}
    out = tfidf.tune(rows, rows, ["toxic"], grid, max_trials=3)
    got = out.orderBy("trial").collect()
    assert [r["params"] for r in got] == [
        "c=0.001,max_iter=10,ngram_range=(1, 1)", "c=0.001,max_iter=10,ngram_range=(1, 2)", "c=4.0,max_iter=10,ngram_range=(1, 1)",
    ]
    best = [r for r in got if r["best"]]
    top = max(r["f1_micro"] for r in got)
    assert len(best) == 1 and best[0]["trial"] == min(r["trial"] for r in got if r["f1_micro"] == top)
    done = spark.createDataFrame([(got[0]["params"], 0.99, 0.5, None)], "params string, f1_micro double, f1_macro double, auc_macro double")
    again = tfidf.tune(rows, rows, ["toxic"], grid, max_trials=1, done=done).collect()
    assert again[0]["f1_micro"] == 0.99 and again[0]["best"]


def test_tuning_goes_on_from_its_store(spark, rows, tmp_path, monkeypatch):
    grid = {"c": [0.5, 4.0], "ngram_range": [(1, 1), (1, 2)], "use_pos_weight": [False, True]}
    store = str(tmp_path / "trials")
    whole = tfidf.tune(rows, rows, ["toxic"], grid, max_trials=8).collect()
    measured = tfidf._measured
    calls = []

    def once(*args):
        if calls:
            raise KeyboardInterrupt
        calls.append(args[3])
        return measured(*args)

    monkeypatch.setattr(tfidf, "_measured", once)
    with pytest.raises(KeyboardInterrupt):
        tfidf.tune(rows, rows, ["toxic"], grid, max_trials=8, store=store)
    assert len(tfidf.finished_trials(spark, store)) == len(calls[0]) == 4
    calls.clear()
    again = tfidf.tune(rows, rows, ["toxic"], grid, max_trials=8, store=store).collect()
    assert again == whole and len(calls[0]) == 4
    monkeypatch.setattr(tfidf, "_measured", None)
    assert tfidf.tune(rows, rows, ["toxic"], grid, max_trials=8, store=store).collect() == whole


def test_weights_by_term(rows):
    model = tfidf.train_tfidf_lr(rows, ["toxic", "never"])
    found = {(r["term"], r["label"]): r["weight"] for r in tfidf.term_weights(model).collect()}
    assert found["bad", "toxic"] > 0 > found[None, "toxic"] and found[None, "never"] == -math.inf
    assert found["good", "toxic"] < 0 and ("bad", "never") not in found
    size = tfidf.gradient_size(model, rows, tfidf.TfidfSettings(), labels="labels").collect()
    assert {r["label"] for r in size if r["size"] < 1e-5} == {"toxic", "never"}


def test_terms_are_counted_before_the_shuffle(spark, monkeypatch):
    """Counts of n-grams by hand, over slices of few words; no row per occurrence is made."""
    texts = [["b", "a", "b", "a", "b"], [], ["a"], ["c", "b", "a", "b"], ["é", "a"]] * 3
    words = spark.createDataFrame([(t,) for t in texts], "w array<string>").repartition(2)
    monkeypatch.setattr(tfidf, "SLICE_WORDS", 6)
    monkeypatch.setattr(tfidf, "ROWS", 3)
    for low, high in ((1, 1), (1, 3), (2, 2)):
        found = tfidf._counted(words, (low, high))
        want, held = Counter(), Counter()
        for t in texts:
            grams = [" ".join(t[i : i + n]) for n in range(low, high + 1) for i in range(len(t) - n + 1)]
            want.update(grams)
            held.update(set(grams))
        rows = {r["term"]: (r["n"], r["texts"]) for r in found.collect()}
        assert rows.pop(None) == (0, len(texts))
        assert rows == {t: (want[t], held[t]) for t in want}
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_slope_check_keeps_no_copy_of_its_rows(rows, monkeypatch):
    settings = tfidf.TfidfSettings()
    model = tfidf.train_tfidf_lr(rows, ["toxic", "never"], settings)

    def never(*args):
        raise AssertionError("rows with all their columns are kept")

    monkeypatch.setattr(type(rows), "persist", never)
    found = {r["label"]: r["size"] for r in tfidf.gradient_size(model, rows, settings).collect()}
    assert set(found) == {"toxic", "never"} and max(found.values()) < 1e-5
