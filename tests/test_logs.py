"""The log counts whole runs: those that are committed, each once."""

import pytest
from pyspark.sql import functions as F

from modspark.constants import ENGLISH_LABELS
from modspark.operators.moderation import ScorerSet, moderate
from modspark.operators.scoring import constant_scorer
from modspark.sources import logs


def records(spark, n, days=("2024-05-06",)):
    rows = spark.createDataFrame([(f"text {i}", "en", days[i % len(days)]) for i in range(n)], "text string, lang string, day string")
    rows = moderate(rows, ScorerSet(constant_scorer("s", ENGLISH_LABELS, [0.4])))
    return logs.prediction_records(rows, F.col("day").cast("timestamp"))


def test_runs_add_up_and_a_named_one_is_replaced(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_json(records(spark, 3), path)
    logs.append_json(records(spark, 4, ("2024-05-06", "2024-05-07")), path)
    logs.append_json(records(spark, 5), path, "evening")
    log, bad = logs.read_prediction_log(spark, path)
    assert log.count() == 12 and bad.count() == 0 and "attempt" not in log.columns
    logs.append_json(records(spark, 2), path, "evening")
    log, _ = logs.read_prediction_log(spark, path)
    assert log.count() == 9 and log.filter("dt = date'2024-05-07'").count() == 2
    assert logs.committed(spark, path).count() == 3


def test_a_killed_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_json(records(spark, 3), path, "morning")

    @F.udf("boolean")
    def fail(action):
        raise RuntimeError("killed")

    broken = records(spark, 50, ("2024-05-06", "2024-05-07")).withColumn("request_human_review", fail("action"))
    with pytest.raises(Exception, match="killed"):
        logs.append_json(broken, path, "morning")
    assert logs.read_prediction_log(spark, path)[0].count() == 3
    # all files are there, but the run ended before its commit
    records(spark, 7).write.partitionBy("dt").json(f"{path}/attempt=a-unfinished")
    assert logs.read_prediction_log(spark, path)[0].count() == 3
    logs.append_json(records(spark, 7), path, "morning")
    assert logs.read_prediction_log(spark, path)[0].count() == 7


def test_broken_lines_of_a_run_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_json(records(spark, 3), path)
    file = next((tmp_path / "log").glob("attempt=*/dt=*/*.json"))
    file.write_text(file.read_text() + "no record\n\n")
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    log, bad = logs.read_prediction_log(spark, path)
    assert log.count() == 3 and [r["line"] for r in bad.collect()] == ["no record"]


def test_an_empty_run_and_an_empty_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.committed(spark, path) is None
    logs.append_json(records(spark, 3).limit(0), path)
    assert logs.read_prediction_log(spark, path)[0].count() == 0
    logs.append_json(logs.review_records(records(spark, 0).select("*", F.lit("t").alias("text")).limit(0), F.lit("2024-01-01").cast("timestamp")), str(tmp_path / "q"))
    assert logs.read_review_queue(spark, str(tmp_path / "q")).count() == 0
