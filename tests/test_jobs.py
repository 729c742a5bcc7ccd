"""The command line, from raw rows to reports."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.__main__ import main
from modspark.sources import logs

RAW = [(f"r{i}", ["bad awful man", "nice tree day", "awful girl", "good moon"][i % 4] + f" w{i % 7}", float(i % 4 in (0, 2))) for i in range(400)]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    spark.createDataFrame(RAW, "id string, comment_text string, toxic double").write.parquet(str(root / "raw"))
    main(["prepare", "--splits", f"train={root}/raw,test={root}/none", "--out", f"{root}/data", "--labels", "toxic"])
    main(["train", "--data", f"{root}/data", "--out", f"{root}/model", "--labels", "toxic", "--max-iter", "20"])
    return root


def table(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(str(path)).collect()]


def test_prepare(spark, root):
    rows = spark.read.parquet(f"{root}/data")
    assert rows.count() == 400
    assert {r[0] for r in rows.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_eval(spark, root):
    models = f"tfidf_lr={root}/model,finetuned={root}/none"
    main(["eval", "--data", f"{root}/data", "--models", models, "--out", f"{root}/eval", "--labels", "toxic"])
    got = {r["model"]: r for r in table(spark, root / "eval")}
    assert got["tfidf_lr"]["f1_micro"] == 1.0 and got["finetuned"]["note"] == "no predictions"


def test_analyses(spark, root):
    common = ["--data", f"{root}/data", "--model", f"{root}/model", "--labels", "toxic"]
    main(["threshold-search", *common, "--out", f"{root}/a"])
    assert table(spark, root / "a/thresholds/global")[0]["f1_micro"] == 1.0
    main(["error-analysis", *common, "--out", f"{root}/b", "--split", "train", "--max-samples", "50"])
    assert table(spark, root / "b/errors/overall")[0]["n"] == 50
    assert len(table(spark, root / "b/errors/cases")) == 50
    main(["fairness", *common, "--out", f"{root}/c", "--split", "train"])
    got = {r["slice"]: r["n"] for r in table(spark, root / "c/fairness/slices")}
    assert got["gender"] == got["any_identity_mention"] > 0 and got["religion"] == 0


def test_moderate_and_report(spark, root):
    rows = [("a", "bad awful man", None, "en"), ("b", None, ["nice tree day", "good moon"], "en"), ("c", "good", None, "unknown")]
    spark.createDataFrame(rows, "request_id string, text string, texts array<string>, lang string").write.parquet(f"{root}/requests")
    main(["moderate", "--data", f"{root}/requests", "--model", f"{root}/model", "--out", f"{root}/served"])
    main(["report", "--log", f"{root}/served/log", "--out", f"{root}/report"])
    got = {(r["section"], r["name"]): r["n"] for r in table(spark, root / "report")}
    assert got["rows", ""] == 4 and got["action", "REVIEW"] >= 1 and got["action", "BLOCK"] == 1
    assert spark.read.json(f"{root}/served/queue").count() == got["action", "REVIEW"]
    main(["report", "--log", f"{root}/served/log", "--out", f"{root}/daily", "--daily"])
    assert {r["day"] for r in table(spark, root / "daily")}


def test_benchmark(spark, root):
    spark.createDataFrame([(float(i),) for i in range(101)], "ms double").write.parquet(f"{root}/ms")
    main(["benchmark", "--data", f"{root}/ms", "--column", "ms", "--out", f"{root}/latency"])
    assert table(spark, root / "latency")[0] == {"n": 101, "p50_ms": 50.0, "p95_ms": 95.0, "p99_ms": 99.0, "mean_ms": 50.0}


def bad_words():
    """A Python model for the command line: the share of known bad words decides."""
    return lambda texts: np.array([[0.9 if "bad" in t or "awful" in t else 0.1] * 1 for t in texts])


def test_other_scorers(spark, root):
    spark.read.parquet(f"{root}/data").withColumn("stored", F.array(F.lit(0.2))).write.mode("overwrite").partitionBy("split").parquet(f"{root}/stored")
    models = f"python=tests.test_jobs:bad_words,stored=column:stored,tfidf={root}/model"
    main(["eval", "--data", f"{root}/stored", "--models", models, "--out", f"{root}/eval2", "--labels", "toxic"])
    got = {r["model"]: r for r in table(spark, root / "eval2")}
    assert got["python"]["f1_micro"] == got["tfidf"]["f1_micro"] == 1.0 and got["stored"]["f1_micro"] == 0.0
    main(["fairness", "--data", f"{root}/stored", "--model", "column:stored", "--labels", "toxic", "--out", f"{root}/c2", "--split", "train"])
    assert table(spark, root / "c2/fairness/slices")


def test_stored_thresholds(spark, root):
    common = ["--data", f"{root}/data", "--model", f"{root}/model", "--labels", "toxic"]
    main(["threshold-search", *common, "--out", f"{root}/a2"])
    main(["apply-thresholds", *common, "--thresholds", f"{root}/a2/thresholds/per_label", "--out", f"{root}/a3"])
    (row,) = table(spark, root / "a3")
    assert row["label"] == "toxic" and row["f1"] == 1.0 and row["fp"] == row["fn"] == 0


def test_all_routes_from_the_job(spark, root):
    six = lambda v: [v, *[0.0] * 5]
    rows = [
        ("low", "en", six(0.1), six(0.1), six(0.0), [0.0, 0.0]),
        ("borderline", "en", six(0.5), six(0.0), [0.9, 0.2, 0.0, 0.0, 0.0, 0.0], [0.0, 0.0]),
        ("vi", "vi", six(0.05), six(0.0), six(0.0), [0.85, 0.1]),
        ("unused", "en", six(0.05), six(0.0), six(0.0), [0.99, 0.99]),
    ]
    kinds = "text string, lang string, f array<double>, m array<double>, t array<double>, v array<double>"
    spark.createDataFrame(rows, kinds).write.parquet(f"{root}/routed")
    (root / "agent.json").write_text(json.dumps({"forced_languages": ["vi"]}))
    for _ in range(2):
        main(["moderate", "--data", f"{root}/routed", "--model", "column:f", "--multilingual", "column:m", "--finetuned", "column:t",
              "--vi", "column:v", "--agent", f"{root}/agent.json", "--store-raw-text", "--run", "first", "--out", f"{root}/served2"])
    log, _ = logs.read_prediction_log(spark, f"{root}/served2/log")
    got = {r["text"]: r for r in log.collect()}
    assert log.count() == 4 and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert {t: r["action"] for t, r in got.items()} == {"low": "ALLOW", "borderline": "REVIEW", "vi": "BLOCK", "unused": "ALLOW"}
    main(["drift", "--log", f"{root}/served2/log", "--reference-until", "2999-01-01", "--out", f"{root}/drift"])
    # runs without a name add to what is there
    for _ in range(2):
        main(["moderate", "--data", f"{root}/routed", "--model", "column:f", "--out", f"{root}/served2"])
    assert logs.read_prediction_log(spark, f"{root}/served2/log")[0].count() == 12
    (root / "agent.json").write_text(json.dumps({"typo": 1}))
    with pytest.raises(ValueError):
        main(["moderate", "--data", f"{root}/routed", "--model", "column:f", "--agent", f"{root}/agent.json", "--out", f"{root}/x"])


def test_classes_leaks_and_retraining(spark, root):
    raw = [(f"text {i}", ["CLEAN", "offensive", "2"][i % 3], ["train", "dev", "test"][i % 5 % 3]) for i in range(30)]
    spark.createDataFrame(raw, "free_text string, label_id string, type string").write.parquet(f"{root}/classes")
    main(["prepare-classes", "--data", f"{root}/classes", "--out", f"{root}/classes_out"])
    assert spark.read.parquet(f"{root}/classes_out/rows").count() == 30 and table(spark, root / "classes_out/summary")
    main(["leak-scan", "--data", f"{root}/classes_out/summary", "--out", f"{root}/leaks"])
    kind = "text_sha256 string, text string, labels array<double>"
    spark.createDataFrame([("h", "t", [1.0])], kind).write.parquet(f"{root}/reviewed")
    main(["retrain-set", "--queue", f"{root}/nothing", "--reviewed", f"{root}/reviewed", "--train", f"{root}/reviewed", "--out", f"{root}/next"])
    assert [r["origin"] for r in spark.read.parquet(f"{root}/next").collect()] == ["train"]
