import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.functions import labels as L
from modspark.functions.numbers import at_least, sigmoid, two_decimals
from modspark.operators.prepare import prepare_labelled, prepare_three_class


def test_class_ids(spark):
    cases = [
        ("CLEAN", 0), ("clean", 0), ("0", 0), (None, 0), ("unknown", 0), ("OFFENSIVE", 1), ("1", 1), ("HATE", 2),
        ("2", 2), (" hate_speech ", 2), ("toxic", 1), ("1.9", 1), ("2.0", 2), ("3", 0), ("-0.5", 0), ("-1", 0),
        ("nan", 0), ("inf", 0), ("1d", 0), ("", 0),
    ]
    df = spark.createDataFrame(cases, "v string, want int")
    got = df.select("v", "want", L.class_id(F.col("v")).alias("got")).collect()
    assert [(r["v"], r["got"]) for r in got] == cases


def test_class_ids_of_numbers(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (7,), (None,)], "v int")
    assert [r[0] for r in df.select(L.class_id(F.col("v"))).collect()] == [0, 1, 2, 0, 0]


def test_three_class_rows(spark):
    rows = [(" a  b ", "HATE", "Dev"), ("c", "1", "TRAINING"), (None, None, None)]
    out = prepare_three_class(spark.createDataFrame(rows, "free_text string, label_id string, type string"))
    got = out.select("text", "labels", "class_id", "class_name", "split", "char_len").collect()
    assert [tuple(r) for r in got] == [
        ("a b", [0.0, 1.0], 2, "HATE", "validation", 3),
        ("c", [1.0, 0.0], 1, "OFFENSIVE", "train", 1),
        ("None", [0.0, 0.0], 0, "CLEAN", "none", 4),
    ]


def test_three_class_columns(spark):
    out = prepare_three_class(spark.createDataFrame([("t", 1)], "comment string, label int"))
    assert out.first()["split"] == "train"
    with pytest.raises(KeyError):
        prepare_three_class(spark.createDataFrame([("t",)], "comment string"))
    with pytest.raises(KeyError):
        prepare_three_class(spark.createDataFrame([("t",)], "label string"))


def test_labelled_rows(spark):
    rows = [
        ("a", " x  y ", "1", 0.0), ("b", None, "0", 1.0), ("c", "t", "-1", 0.0), ("d", "t", None, 0.0),
        ("e", "t", "bad", 0.0), ("f", "t", "NaN", 0.0), ("g", "t", " 0.5 ", 0.0),
    ]
    df = spark.createDataFrame(rows, "id string, comment_text string, toxic string, threat double")
    out = {r["id"]: r for r in prepare_labelled(df, "comment_text", ["toxic", "threat"], "id").collect()}
    assert sorted(out) == ["a", "b", "f", "g"]
    assert (out["a"]["text"], out["a"]["labels"]) == ("x y", [1.0, 0.0])
    assert (out["b"]["text"], out["b"]["labels"]) == ("", [0.0, 1.0])
    assert out["g"]["labels"] == [0.5, 0.0]


def test_missing_label_column(spark):
    df = spark.createDataFrame([("a", "t", 1)], "id string, text string, toxic int")
    assert prepare_labelled(df, "text", ["toxic", "threat"]).count() == 0
    assert df.select(L.label_vector(df, ["toxic", "threat"])).first()[0] == [1.0, 0.0]


def test_positive_rows(spark):
    rows = [([0.0, 1.0],), ([0.0, 0.0],), ([float("nan"), 0.0],), ([-1.0],)]
    df = spark.createDataFrame(rows, "labels array<double>")
    assert [r[0] for r in df.select(L.any_positive(F.col("labels"))).collect()] == [True, False, False, False]


def test_rekey(spark):
    df = spark.range(1).select(F.create_map(F.lit("toxic"), F.lit(0.25), F.lit("identity_attack"), F.lit(0.5)).alias("m"))
    scores = L.rekey(F.col("m"), ["identity_hate", "toxic", "threat"], {"identity_hate": "identity_attack"})
    assert df.select(scores).first()[0] == [0.5, 0.25, 0.0]


def test_float_thresholds(spark):
    cuts = [round(0.05 * i, 2) for i in range(1, 20)]
    df = spark.createDataFrame([(float(np.float32(t)), t) for t in cuts], "p float, t double")
    assert all(r[0] for r in df.select(at_least(F.col("p"), F.col("t"))).collect())
    below = [(float(np.nextafter(np.float32(t), np.float32(0))), t) for t in cuts] + [(float("nan"), 0.5)]
    df = spark.createDataFrame(below, "p float, t double")
    assert not any(r[0] for r in df.select(at_least(F.col("p"), F.col("t"))).collect())


def test_two_decimals(spark):
    rng = np.random.default_rng(5)
    values = [np.float32(x) for x in [0, 0.125, 0.625, 0.375, 0.005, 0.015, 1, 0.995, 0.285, *rng.random(2000)]]
    df = spark.createDataFrame([(float(v),) for v in values], "s double")
    got = [r[0] for r in df.select(two_decimals(F.col("s"))).collect()]
    assert got == [f"{float(v):.2f}" for v in values]


def test_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (-800.0,)], "x double")
    got = [r[0] for r in df.select(sigmoid(F.col("x"))).collect()]
    assert got == pytest.approx([0.5, 1 / (1 + np.exp(-2.0)), 0.0])
