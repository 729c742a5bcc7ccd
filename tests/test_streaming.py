"""Streams give what the batch jobs give, and a replay adds nothing."""

import json

from pyspark.sql import functions as F

from modspark.constants import ENGLISH_LABELS
from modspark.operators.moderation import ScorerSet, moderate
from modspark.operators.scoring import constant_scorer
from modspark.sources import logs
from modspark.operators.monitoring import rolling_f1
from modspark.streaming import daily, quality
from modspark.streaming.moderation import OncePerRequest, StreamTargets, moderate_stream

SCORERS = ScorerSet(constant_scorer("s", ENGLISH_LABELS, [0.4]))
def stamp():
    return F.lit("2024-05-06 07:08:09").cast("timestamp")



def write_texts(spark, folder, start):
    rows = [(f"text {i}", ["en", "fr", "unknown"][i % 3]) for i in range(start, start + 10)]
    spark.createDataFrame(rows, "text string, lang string").coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, targets):
    texts = spark.readStream.schema("text string, lang string").option("maxFilesPerTrigger", 1).parquet(folder)
    moderate_stream(texts, SCORERS, targets, ts=stamp()).awaitTermination()


def test_moderation(spark, tmp_path):
    folder = str(tmp_path / "in")
    targets = StreamTargets(*[str(tmp_path / x) for x in ("log", "queue", "checkpoint")])
    write_texts(spark, folder, 0)
    write_texts(spark, folder, 10)
    run(spark, folder, targets)
    write_texts(spark, folder, 20)
    run(spark, folder, targets)
    log, bad = logs.read_prediction_log(spark, targets.log)
    assert bad.count() == 0
    batch = moderate(spark.read.parquet(folder), SCORERS)
    want = logs.prediction_records(batch, stamp()).select("text_sha256", "action", "language")
    got = log.select("text_sha256", "action", "language")
    assert got.count() == 30 and got.exceptAll(want).count() == 0
    queue = logs.read_review_queue(spark, targets.queue)
    assert queue.count() == batch.filter("request_human_review").count() > 0


def test_replay(spark, tmp_path):
    """A batch that ran but was not committed runs again and replaces its output."""
    folder = str(tmp_path / "in")
    targets = StreamTargets(*[str(tmp_path / x) for x in ("log", "queue", "checkpoint")])
    write_texts(spark, folder, 0)
    run(spark, folder, targets)
    commits = tmp_path / "checkpoint" / "commits"
    kept = str(tmp_path / "checkpoint-before-commit")
    # the same checkpoint without its commit log is the state after a crash
    import shutil

    shutil.copytree(tmp_path / "checkpoint", kept, ignore=shutil.ignore_patterns("commits"))
    assert list(commits.iterdir())
    run(spark, folder, StreamTargets(targets.log, targets.queue, kept))
    log, _ = logs.read_prediction_log(spark, targets.log)
    assert log.count() == 10


def log_rows(day, hours, score):
    return [(f"2024-01-{day:02d} {h:02d}:30:00", None if h % 5 == 0 else "ALLOW", "en" if h % 2 else None, score) for h in hours]


def test_daily(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "ts timestamp, action string, language string, overall_score double"

    def write(rows):
        df = spark.createDataFrame(rows, "ts string, action string, language string, overall_score double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)

    def run(start, name):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        start(daily.daily_counts(stream), str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")).awaitTermination()

    def rows(df):
        return sorted(json.dumps([str(r[0]), *r[1:]]) for r in df.collect())

    write(log_rows(1, range(0, 20), 0.5))
    write(log_rows(1, range(10, 24), 0.25) + log_rows(2, range(0, 3), 0.75))
    for name, start in (("closed", daily.append_closed_days), ("live", daily.update_open_days)):
        run(start, name)
    write(log_rows(2, range(3, 24), 0.125) + log_rows(3, range(4, 6), 1.0))
    for name, start in (("closed", daily.append_closed_days), ("live", daily.update_open_days)):
        run(start, name)
    everything = daily.daily_counts(spark.read.parquet(folder))
    closed = spark.read.schema(everything.schema).parquet(str(tmp_path / "closed"))
    assert rows(closed) == rows(everything.filter("day < '2024-01-03'"))
    live = daily.latest_days(spark.read.parquet(str(tmp_path / "live")))
    assert rows(live) == rows(everything)
    # two days late: the day is closed, the row is dropped
    write(log_rows(1, [12], 9.0))
    run(daily.append_closed_days, "closed")
    assert rows(spark.read.schema(everything.schema).parquet(str(tmp_path / "closed"))) == rows(closed)


def test_compacted_days_replace_their_updates(spark, tmp_path):
    rows = [("2024-01-01", "ALLOW", 1, 0.1, 0), ("2024-01-01", "ALLOW", 3, 0.3, 1), ("2024-01-02", "WARN", 2, 0.5, 1), ("2024-01-02", "WARN", 4, 0.6, 2)]
    updates = spark.createDataFrame([(d, a, "en", n, s, b) for d, a, n, s, b in rows], "day string, action string, language string, n long, mean_score double, batch_id int")
    updates = updates.withColumn("day", F.col("day").cast("timestamp"))
    path = str(tmp_path / "closed")
    for _ in range(2):
        daily.compact_days(updates, path, "2024-01-02")
    closed = spark.read.parquet(path)
    assert [(r["n"], str(r["dt"])) for r in closed.collect()] == [(3, "2024-01-01")]
    plan = closed.filter("dt = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    found = daily.all_days(updates, closed, "2024-01-02").orderBy("day").collect()
    assert [(r["action"], r["n"]) for r in found] == [("ALLOW", 3), ("WARN", 4)]


def send(spark, folder, rows):
    kind = "request_id string, text string, lang string, ts string"
    rows = spark.createDataFrame([(i, t, "en", f"2024-05-06 {at}") for i, t, at in rows], kind)
    rows.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)


def test_a_request_is_logged_once_within_the_horizon(spark, tmp_path):
    folder = str(tmp_path / "in")
    targets = StreamTargets(*[str(tmp_path / x) for x in ("log", "queue", "checkpoint")])
    schema = "request_id string, text string, lang string, ts timestamp"

    def run_all():
        texts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        moderate_stream(texts, SCORERS, targets, ts=stamp(), once=OncePerRequest(horizon="1 hour")).awaitTermination()
        log, _ = logs.read_prediction_log(spark, targets.log)
        return sorted((r["text_sha256"], r["count"]) for r in log.groupBy("text_sha256").count().collect())

    def expected(counts):
        rows = spark.createDataFrame(list(counts.items()), "t string, n int").select(F.sha2("t", 256), "n")
        return sorted(tuple(r) for r in rows.collect())

    send(spark, folder, [("a", "one", "08:00:00"), ("a", "one", "08:00:01"), (None, "none", "08:00:00"), (None, "none", "08:00:00")])
    assert run_all() == expected({"one": 1, "none": 2})
    # sent again in a later micro-batch
    send(spark, folder, [("a", "one", "08:20:00"), ("b", "two", "08:20:00"), (None, "none", "08:20:00")])
    assert run_all() == expected({"one": 1, "two": 1, "none": 3})
    # the watermark passes the horizon; the id is free again
    send(spark, folder, [("c", "three", "12:00:00")])
    send(spark, folder, [("d", "four", "12:01:00")])
    run_all()
    send(spark, folder, [("a", "one", "12:02:00"), ("c", "three", "12:02:00")])
    assert run_all() == expected({"one": 2, "two": 1, "three": 1, "four": 1, "none": 3})


def test_rolling_f1_as_labels_come_in(spark, tmp_path):
    """Late labels and decisions in several micro-batches give what the batch job gives."""
    log, truth = str(tmp_path / "log"), str(tmp_path / "truth")
    kinds = {log: "ts timestamp, text_sha256 string, label_scores map<string,double>", truth: "labelled_at timestamp, text_sha256 string, labels array<double>"}

    def add(path, rows):
        first = kinds[path].split()[0]
        raw = spark.createDataFrame(rows, kinds[path].replace("timestamp", "string", 1))
        raw.withColumn(first, F.col(first).cast("timestamp")).coalesce(1).write.mode("append").parquet(path)

    def go():
        sides = [spark.readStream.schema(kinds[p]).option("maxFilesPerTrigger", 1).parquet(p) for p in (log, truth)]
        rows = quality.judged(*sides, ["toxic"], quality.LabelDelay("5 days", "7 days", "1 hour"))
        quality.append_counts(rows, ["toxic"], str(tmp_path / "counts"), str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(map(tuple, quality.current_f1(spark, str(tmp_path / "counts"), 3).collect()))

    def decided(day, hashes):
        return [(f"2024-05-{day:02d} 10:00:00", h, {"toxic": 0.1 + 0.2 * (i % 5)}) for i, h in enumerate(hashes)]

    names = [f"h{i}" for i in range(20)]
    add(log, decided(1, names) + decided(1, names[:3]))
    add(truth, [("2024-05-01 12:00:00", h, [float(i % 2)]) for i, h in enumerate(names[:10])])
    early = go()
    assert early and early[0][2] == 13
    add(log, decided(2, names[5:15]))
    add(truth, [("2024-05-03 12:00:00", h, [float(i % 3 == 0)]) for i, h in enumerate(names[10:])])
    add(log, decided(4, names[::2]))
    found = go()
    batch_log = spark.read.schema(kinds[log]).parquet(log).withColumn("day", F.to_date("ts"))
    batch = rolling_f1(batch_log, spark.read.schema(kinds[truth]).parquet(truth), "day", ["toxic"], 0.5, 3)
    assert found == sorted(map(tuple, batch.collect()))
    # a label beyond the delay and one for a text that was never decided add nothing
    add(truth, [("2024-05-30 12:00:00", "h1", [1.0]), ("2024-05-30 12:00:00", "other", [1.0])])
    assert go() == found
    # what no label can meet any more is no longer kept
    add(log, decided(30, ["x"]))
    add(truth, [("2024-05-31 12:00:00", "z", [1.0])])
    go()
    sides = [spark.readStream.schema(kinds[p]).option("maxFilesPerTrigger", 1).parquet(p) for p in (log, truth)]
    rows = quality.judged(*sides, ["toxic"], quality.LabelDelay("5 days", "7 days", "1 hour"))
    add(log, decided(31, ["y"]))
    query = quality.append_counts(rows, ["toxic"], str(tmp_path / "counts"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    kept = sum(o["numRowsTotal"] for o in json.loads(query.lastProgress.json)["stateOperators"])
    assert kept < 20
