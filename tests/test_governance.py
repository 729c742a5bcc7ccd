"""Leak scan, overfit flags, drift, rolling F1, retraining set, language model."""

import math

import pytest
from pyspark.sql import functions as F

from modspark.operators import governance, langid, monitoring


def test_leak_scan(spark):
    schema = """id int, text string, a struct<b:string, content:string, deep:struct<message:string>>,
        list array<struct<raw_text:string, n:int>>, m map<string,string>, ms map<string,struct<text:string>>, n int"""
    clean = (1, " \t", ("x", None, ("",)), [("", 1)], {"note": "x", "text": " "}, {"k": ("",)}, 1)
    leaky = (2, "t", ("x", "c", ("m",)), [("", 1), ("r", 2)], {"text": "boo"}, {"k": ("z",)}, 1)
    df = spark.createDataFrame([clean, leaky, clean], schema)
    found = {r["path"]: r["n_leaks"] for r in governance.leak_scan(df).collect()}
    assert {p for p, n in found.items() if n} == {
        "text", "a.content", "a.deep.message", "list[].raw_text", "m.text", "ms{}.text",
    }
    assert set(found.values()) == {0, 1}
    assert governance.has_leak(df) and not governance.has_leak(df.filter("id = 1"))
    assert not governance.has_leak(df.select("n"))


def runs(spark, rows):
    return spark.createDataFrame(
        rows, "run string, step long, loss double, eval_loss double, eval_f1_micro double, best_metric double"
    )


def test_overfit_flags(spark):
    rows = [
        # rebound: evaluation loss rises while training loss falls
        ("r", 1, 1.0, 0.9, None, None), ("r", 2, 0.9, 0.8, None, None), ("r", 3, None, 0.85, None, None),
        # gap between the last losses
        ("g", 1, 0.5, None, None, None), ("g", 2, None, 0.9, None, None),
        # best metric above the last one
        ("m", 1, None, None, 0.8, 0.8), ("m", 2, None, None, 0.75, 0.8),
        # healthy
        ("h", 1, 1.0, 1.0, 0.5, 0.6), ("h", 2, 0.9, 0.9, 0.6, 0.6), ("h", 3, 0.8, 0.8, 0.6, 0.6),
        # rebound needs three evaluations
        ("s", 1, 1.0, 0.8, None, None), ("s", 2, 0.95, 0.9, None, None),
    ]
    got = {r["run"]: (r["loss_rebound"], r["loss_gap"], r["metric_drop"], r["overfit"]) for r in governance.overfit_flags(runs(spark, rows)).collect()}
    assert got == {
        "r": (True, False, False, True),
        "g": (False, True, False, True),
        "m": (False, False, True, True),
        "h": (False, False, False, False),
        "s": (False, False, False, False),
    }


def test_latest_artifacts(spark):
    df = spark.createDataFrame([("e", "e-1", "a"), ("e", "e-3", "c"), ("e", "e-2", "b")], "kind string, run_name string, payload string")
    got = {r["kind"]: tuple(r)[1:] for r in governance.latest_artifacts(df, ["e", "t"]).collect()}
    assert got == {"e": ("e-3", "c"), "t": (None, None)}


def test_drift(spark):
    rows = [(1, "s", "x", 60), (1, "s", "y", 40), (2, "s", "x", 10), (2, "s", "z", 30), (3, "s", "x", 6), (3, "s", "y", 4)]
    df = spark.createDataFrame(rows, "day int, signal string, bin string, n long")
    got = {r["day"]: r["psi"] for r in monitoring.drift(df, "day", F.col("day") == 1).collect()}

    def psi(a, b):
        return sum((x - y) * math.log(x / y) for x, y in ((max(x, 1e-6), max(y, 1e-6)) for x, y in zip(a, b)))

    assert got[1] == pytest.approx(0, abs=1e-12) and got[3] == pytest.approx(0, abs=1e-12)
    assert got[2] == pytest.approx(psi([0.25, 0, 0.75], [0.6, 0.4, 0]))


def test_rolling_f1(spark):
    log = spark.createDataFrame(
        [(d, h, {"a": s}) for d, h, s in [(1, "p", 0.9), (1, "n", 0.9), (2, "p", 0.1), (9, "p", 0.9), (9, "p", 0.9), (9, "x", 0.9)]],
        "day int, text_sha256 string, label_scores map<string,double>",
    )
    truth = spark.createDataFrame([("p", [1.0]), ("n", [0.0])], "text_sha256 string, labels array<double>")
    got = {r["day"]: (r["n"], r["f1"]) for r in monitoring.rolling_f1(log, truth, "day", ["a"], days=2).collect()}
    assert got == {1: (2, pytest.approx(2 / 3)), 2: (3, 0.5), 9: (3, 0.8)}


def test_retraining_set(spark):
    def rows(keys):
        return spark.createDataFrame([(k, f"text {k}", [1.0]) for k in keys], "text_sha256 string, text string, labels array<double>")

    queue = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "text_sha256 string")
    out = monitoring.retraining_set(queue, rows("aabdd"), rows("bee"))
    assert sorted((r["text_sha256"], r["text"], r["origin"]) for r in out.collect()) == [
        ("a", "text a", "review"), ("b", "text b", "train"), ("e", "text e", "train"),
    ]


def test_language_model(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "this is the end", "en"), (3, "der hund und die katze", "de"), (4, "das ist das ende", "de")]
    model = langid.train(spark.createDataFrame(rows, "id int, text string, lang string"))
    assert model.languages == ["de", "en"]
    new = spark.createDataFrame([(1, "the dog is here"), (2, "die katze ist da"), (3, "ab"), (4, None), (5, "")], "id int, text string")
    got = {r["id"]: r["lang"] for r in langid.identify(new, model, "id").collect()}
    assert got == {1: "en", 2: "de", 3: "unknown", 4: "unknown", 5: "unknown"}
    told = langid.with_language(new.union(new), model)
    assert [r["lang"] for r in told.orderBy("id").collect()] == [got[i] for i in (1, 1, 2, 2, 3, 3, 4, 4, 5, 5)]


def test_trigrams_are_characters(spark):
    rows = spark.createDataFrame([("a😀bc",), ("😀😀",), ("xyz",)], "text string")
    assert [r[0] for r in rows.select(langid.trigrams(F.col("text"))).collect()] == [["a😀b", "😀bc"], [], ["xyz"]]


def test_language_model_keeps_all_trigrams_and_languages(spark):
    signs = [chr(0x4E00 + i) for i in range(120)]
    rare = [(f"{signs[i // 450 % 120]}{signs[i // 4 % 113]}{chr(0x5000 + i % 9000)}", "zh") for i in range(52_000)]
    rows = rare + [(f"qq{chr(0x6000 + i)}", f"l{i:03}") for i in range(600)] + [("null", None)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    model = langid.train(frame)
    assert len(model.languages) == 601 and model.grams.select("gram").distinct().count() > 50_000
    asked = spark.createDataFrame([(1, f"qq{chr(0x6000 + 599)}"), (2, rare[-1][0])], "id int, text string")
    assert {r["id"]: r["lang"] for r in langid.identify(asked, model, "id").collect()} == {1: "l599", 2: "zh"}


def test_retraining_set_does_not_follow_row_order(spark):
    kind = "text_sha256 string, text string, labels array<double>"
    queue = spark.createDataFrame([("a",)], "text_sha256 string")
    two = [("b", "t", [0.0]), ("b", "t", [1.0])]
    for rows in (two, two[::-1]):
        train = spark.createDataFrame(rows, kind).coalesce(1)
        found = monitoring.retraining_set(queue, train, train).collect()
        assert [r["labels"] for r in found] == [[1.0]]


def test_latency_with_nan_and_infinity(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(97)] + [(float("inf"),), (float("inf"),), (float("nan"),)], "ms double")
    found = monitoring.latency_summary(rows, "ms").first()
    assert found["n"] == 100 and found["p50_ms"] == 49.5 and found["p95_ms"] == 94.05
    assert found["p99_ms"] == float("inf") or found["p99_ms"] != found["p99_ms"]
    endless = monitoring.latency_summary(spark.createDataFrame([(float("inf"),)] * 3, "ms double"), "ms").first()
    assert endless["p50_ms"] == endless["mean_ms"] == float("inf")


def test_model_meets_pieces_batch_by_batch(spark, monkeypatch):
    """The large-model path gives the small one's answers and holds no range's pieces as a whole."""
    rows = [(i, ("ab cd " * (i % 7 + 1) if i % 2 else "xy zw é " * (i % 5 + 1)) if i % 11 else None, "aa" if i % 2 else "bb") for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, text string, lang string").repartition(3)
    model = langid.train(frame)
    monkeypatch.setattr(langid, "SLICE_CHARS", 64)
    small = {r["id"]: r["lang"] for r in langid.identify(frame, model, "id").collect()}
    large = langid.identify(frame, model, "id", broadcast_bytes=0)
    assert {r["id"]: r["lang"] for r in large.collect()} == small and small[11] == "unknown" and small[1] == "aa" and small[2] == "bb"
    assert "CoGroup" not in large._jdf.queryExecution().executedPlan().toString()
