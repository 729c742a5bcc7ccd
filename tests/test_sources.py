"""Readers, sinks, settings files and monitoring reports."""

import json

import pytest
from pyspark.sql import functions as F

from modspark.config import LogSettings
from modspark.operators import monitoring
from modspark.operators.moderation import ScorerSet, moderate
from modspark.operators.scoring import constant_scorer
from modspark.constants import ENGLISH_LABELS
from modspark.plans import jobs
from modspark.sources import datasets, logs, reports, requests, settings_files

def stamp():
    return F.lit("2024-05-06 07:08:09").cast("timestamp")



def decisions(spark):
    rows = [("hello a@b.co", "en"), ("hm", "unknown"), ("other", "fr")]
    df = spark.createDataFrame(rows, "text string, lang string")
    return moderate(df, ScorerSet(constant_scorer("s", ENGLISH_LABELS, [0.2])), with_redaction=True)


def test_requests(spark):
    rows = [("r1", "one", None), ("r2", "x", ["a", "b"]), ("r3", None, None), ("r4", "x", []), ("r5", None, ["c"])]
    df = spark.createDataFrame(rows, "request_id string, text string, texts array<string>")
    got = [tuple(r) for r in requests.request_texts(df).orderBy("request_id", "pos").collect()]
    assert got == [("r1", 0, "one"), ("r2", 0, "a"), ("r2", 1, "b"), ("r5", 0, "c")]


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_json(logs.prediction_records(decisions(spark), stamp()), path)
    logs.append_json(logs.prediction_records(decisions(spark), stamp()), path)
    log, bad = logs.read_prediction_log(spark, path)
    assert log.count() == 6 and bad.count() == 0
    row = log.filter("language = 'en'").first()
    assert row["ts_utc"] == "2024-05-06T07:08:09.000000" and str(row["dt"]) == "2024-05-06"
    assert row["text"] is None and row["text_redacted"] is None
    assert float(row["label_scores"]["toxic"]) == pytest.approx(0.2)
    written = "".join(p.read_text() for p in (tmp_path / "log").rglob("*.json"))
    assert "hello" not in written


def test_log_text_flags(spark):
    rows = decisions(spark)
    both = logs.prediction_records(rows, stamp(), LogSettings(True, True))
    assert [r["text_redacted"] for r in both.collect()][0] == "hello <EMAIL>"
    assert "text" in both.columns
    assert "text" not in logs.prediction_records(rows, stamp(), LogSettings(False, True)).columns


def test_review_queue(spark, tmp_path):
    path = str(tmp_path / "queue")
    logs.append_json(logs.review_records(decisions(spark), stamp()), path)
    queue = logs.read_review_queue(spark, path).collect()
    assert len(queue) == 1 and queue[0]["language"] == "unknown" and len(queue[0]["text_sha256"]) == 64
    assert logs.read_review_queue(spark, str(tmp_path / "none")).count() == 0


LINES = [
    '{"action": "ALLOW", "language": "en", "overall_score": 0.5, "label_scores": {"a": 0.25, "b": 1}}',
    "",
    "   ",
    "{broken",
    '{"language": "fr", "overall_score": "0.25", "label_scores": {"a": "0.75", "b": "n/a"}}',
    '{"action": "BLOCK", "overall_score": "high"}',
    '{"action": "BLOCK", "language": "en", "label_scores": {"c": 0.5, "d": null}, "extra": [1]}',
]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    file = tmp_path_factory.mktemp("log") / "predictions.jsonl"
    file.write_text("\n".join(LINES) + "\n")
    return logs.read_prediction_log(spark, str(file))


def test_bad_lines(log):
    assert log[0].count() == 4
    assert [r["line"] for r in log[1].collect()] == ["{broken"]


def test_monitoring(log):
    got = monitoring.action_counts(log[0]).collect()
    assert {r["action"]: r["n"] for r in got} == {"ALLOW": 1, "BLOCK": 2, "UNKNOWN": 1}
    got = monitoring.language_counts(log[0]).collect()
    assert {r["language"]: r["n"] for r in got} == {"en": 2, "fr": 1, "unknown": 1}
    # a missing score counts as 0, text that is no number is dropped
    assert monitoring.mean_overall_score(log[0]).first()[0] == pytest.approx(0.25)
    got = {r["label"]: r["mean_score"] for r in monitoring.mean_label_scores(log[0]).collect()}
    assert got == {"a": 0.5, "b": 1.0, "c": 0.5}


def test_report(log):
    got = {(r["section"], r["name"]): (r["n"], r["mean"]) for r in monitoring.report(log[0]).collect()}
    assert got == {
        ("rows", ""): (4, None),
        ("action", "ALLOW"): (1, None),
        ("action", "BLOCK"): (2, None),
        ("action", "UNKNOWN"): (1, None),
        ("language", "en"): (2, None),
        ("language", "fr"): (1, None),
        ("language", "unknown"): (1, None),
        ("overall_score", ""): (3, 0.25),
        ("label_score", "a"): (2, 0.5),
        ("label_score", "b"): (1, 1.0),
        ("label_score", "c"): (1, 0.5),
    }


def test_empty_log(spark, tmp_path):
    log, bad = logs.read_prediction_log(spark, str(tmp_path / "missing"))
    assert log.count() == 0 and bad.count() == 0
    got = {r["section"]: (r["n"], r["mean"]) for r in monitoring.report(log).collect()}
    assert got == {"rows": (0, None), "overall_score": (0, 0.0)}
    assert monitoring.mean_overall_score(log).first()[0] == 0.0


def test_splits(spark, tmp_path):
    full = spark.createDataFrame([("1", " a ", 1), ("2", "b", 0), ("3", "c", -1)], "id string, t string, toxic int")
    full.write.parquet(str(tmp_path / "full"))
    full.drop("toxic").write.parquet(str(tmp_path / "bare"))
    paths = {"train": "full", "validation": "missing", "test": "bare"}
    found = datasets.load_splits(spark, {k: str(tmp_path / v) for k, v in paths.items()}, ["toxic"])
    assert set(found) == {"train"}
    paths = {"dev": "full", "test": "full"}
    found = datasets.load_splits(spark, {k: str(tmp_path / v) for k, v in paths.items()}, ["toxic"])
    assert set(found) == {"train", "test"}
    with pytest.raises(FileNotFoundError):
        datasets.load_splits(spark, {"train": str(tmp_path / "missing")}, ["toxic"])
    rows = datasets.load_prepared({"train": full, "validation": full, "test": full}, "t", ["toxic"], "id")
    assert {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()} == {"train": 2, "validation": 2, "test": 2}
    out = str(tmp_path / "out")
    datasets.export_splits(rows, out, max_rows=1)
    back = spark.read.parquet(out)
    assert back.count() == 3
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_csv_splits(spark, tmp_path):
    (tmp_path / "train.csv").write_text("id,comment_text,toxic\n1,hello,1\n2,there,\n")
    schema = spark.createDataFrame([], "id string, comment_text string, toxic double").schema
    found = datasets.load_splits(spark, {"train": str(tmp_path / "train.csv")}, ["toxic"], "csv", schema, header=True)
    rows = datasets.load_prepared(found, "comment_text", ["toxic"], "id")
    assert [r["id"] for r in rows.collect()] == ["1"]


def test_csv_records_with_line_ends_and_quotes(spark, tmp_path):
    (tmp_path / "train.csv").write_text('id,comment_text,toxic\n1,"two\nlines",1\n2,"she said ""no"", twice",0\n3,plain,1\n')
    jobs.prepare(spark, {"train": str(tmp_path / "train.csv")}, str(tmp_path / "out"), "comment_text", ["toxic"], "id", "csv")
    found = {r["id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found.keys() == {"1", "2", "3"} and '"no"' in found["2"] and "lines" in found["1"]
    (tmp_path / "bad.csv").write_text('id,comment_text,toxic\n1,a,1,9,9\n')
    broken = datasets.load_splits(spark, {"train": str(tmp_path / "bad.csv")}, ["toxic"], "csv")["train"]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        broken.collect()


def test_settings_files(spark, tmp_path):
    policy = {"actions": {"ALLOW": {"user_message": "fine"}, "X": {}}, "labels": {"a": {"display_name": "A!"}, "b": {}}}
    (tmp_path / "p.json").write_text(json.dumps(policy))
    rules = settings_files.load_policy(str(tmp_path / "p.json"))
    assert rules.action_messages == {"ALLOW": "fine", "X": ""} and rules.label_names == {"a": "A!", "b": "b"}
    assert (rules.top_k, rules.include_scores) == (3, True)
    (tmp_path / "g.json").write_text(json.dumps({"groups": {"x": [" a ", "", 7], "y": []}}))
    groups = settings_files.load_groups(str(tmp_path / "g.json"))
    assert groups == {"x": ["a", "7"], "y": []}
    assert settings_files.groups_frame(spark, groups).count() == 2
    for content in ({"groups": [1]}, {}, {"groups": {"x": "a"}}):
        (tmp_path / "bad.json").write_text(json.dumps(content))
        with pytest.raises(ValueError):
            settings_files.load_groups(str(tmp_path / "bad.json"))


def test_yaml_settings(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "g.yaml").write_text("groups:\n  x:\n    - a\n    - ' b '\n")
    assert settings_files.load_groups(str(tmp_path / "g.yaml")) == {"x": ["a", "b"]}


def test_reports(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, value double")
    reports.save_report(table, str(tmp_path / "r"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "r")).collect())
    assert [json.loads(x) for x in lines] == [{"name": "a", "value": 1.5}, {"name": "b", "value": None}]
    for kind, name in (("eval", "eval-2024"), ("eval", "eval-2025"), ("tune", "tune-1")):
        (tmp_path / "runs" / kind).mkdir(parents=True, exist_ok=True)
        (tmp_path / "runs" / kind / f"{name}.json").write_text(json.dumps({"run": name}))
    got = {r["kind"]: (r["run_name"], r["payload"]) for r in reports.newest_reports(spark, str(tmp_path / "runs"), ["eval", "tune", "fairness"]).collect()}
    assert got["eval"] == ("eval-2025", '{"run": "eval-2025"}')
    assert got["tune"][0] == "tune-1" and got["fairness"] == (None, None)
