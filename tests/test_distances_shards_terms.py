"""Distances without bins, quantile sketches, exported shards, long term lists, batches of like lengths."""

import datetime as dt
import hashlib
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from modspark.functions.slices import slices_of
from modspark.operators import errors, monitoring, sampling, scoring
from modspark.operators.identity import TermAutomaton, term_slice_rows, term_slices
from modspark.sources import shards


def test_distances_by_hand(spark):
    rng = np.random.default_rng(2)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    values = {
        days[0]: rng.normal(size=300), days[1]: np.round(rng.normal(1, 2, size=200), 1),
        days[2]: np.array([0.5]), days[3]: np.concatenate((rng.exponential(size=50), [-1e9, 1e-300, 0.0])),
    }
    rows = [(d, float(v)) for d, vs in values.items() for v in vs] + [(days[0], None), (days[1], float("nan")), (None, 3.0)]
    frame = spark.createDataFrame(rows, "day date, v double").repartition(5)
    found = {r["day"]: r for r in monitoring.sample_distances(frame, "day", "v", F.col("day") <= days[1]).collect()}
    reference = np.sort(np.concatenate((values[days[0]], values[days[1]])))
    assert set(found) == set(days)
    for day, own in values.items():
        own = np.sort(own)
        points = np.unique(np.concatenate((own, reference)))
        gap = np.abs(np.searchsorted(own, points, "right") / len(own) - np.searchsorted(reference, points, "right") / len(reference))
        assert found[day]["n"] == len(own) and found[day]["ks"] == pytest.approx(gap.max(), abs=1e-12)
        assert found[day]["wasserstein"] == pytest.approx((gap[:-1] * np.diff(points)).sum(), rel=1e-9)
    nothing = monitoring.sample_distances(frame, "day", "v", F.lit(False)).collect()
    assert len(nothing) == 4 and all(r["ks"] is None and r["wasserstein"] is None for r in nothing)
    assert monitoring.sample_distances(frame.limit(0), "day", "v", F.lit(True)).count() == 0


def test_stored_sketches_cover_any_window(spark):
    rng = np.random.default_rng(4)
    rows = [(d, "a" if i % 3 else "b", float(v)) for d in range(30) for i, v in enumerate(rng.lognormal(d / 10, 1.0, size=400))]
    frame = spark.createDataFrame([*rows, (3, "a", None), (4, "a", float("nan"))], "day int, kind string, ms double")
    stored = monitoring.latency_sketches(frame, "ms", ["day", "kind"])
    assert stored.count() == 60
    for window in (range(30), range(5, 12)):
        for keys, kinds in (([], ["a", "b"]), (["kind"], ["a"])):
            found = monitoring.sketched_latency(stored.filter(F.col("day").isin(list(window))), keys).filter("kind = 'a'" if keys else "true").first()
            own = np.sort([v for d, k, v in rows if d in window and k in kinds])
            assert found["n"] == len(own) and found["mean_ms"] == pytest.approx(own.mean())
            for q in (50, 95, 99):
                rank = np.searchsorted(own, found[f"p{q}_ms"], "right") / len(own)
                assert abs(rank - q / 100) <= monitoring.sketch_rank_error()


def test_shards_are_the_seeded_order(spark, tmp_path):
    rows = spark.createDataFrame([(i * 7 % 1009, f"text {i}") for i in range(1000)], "id int, text string").repartition(6)
    path = str(tmp_path / "out")
    manifest = shards.export_shards(rows, ["id"], path, 7)
    stored = spark.read.parquet(f"{path}/rows")
    placed = shards.positions(stored, manifest, ["id"]).orderBy("position").collect()
    assert [r["id"] for r in placed] == [r["id"] for r in sampling.shuffled(rows, ["id"]).collect()]
    assert [r["position"] for r in placed] == list(range(1000))
    sizes = [r["rows"] for r in manifest.orderBy("shard").collect()]
    assert len(sizes) == 7 and sum(sizes) == 1000 and max(sizes) < 160
    files = sorted((tmp_path / "out" / "rows").glob("shard=*/*.parquet"))
    assert len(files) == 7
    # one file alone is in order
    own = pd.read_parquet(files[0])
    assert own["_key"].is_monotonic_increasing
    assert all(r["intact"] for r in shards.shards_with(stored, manifest, ["id", "text"]).collect())
    files[2].unlink()
    broken = {r["shard"] for r in shards.shards_with(spark.read.parquet(f"{path}/rows"), manifest, ["id", "text"]).collect() if not r["intact"]}
    assert len(broken) == 1


def test_an_ended_export_goes_on(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "id int, text string").repartition(3)
    path, measured, calls = str(tmp_path / "out"), shards._measured, []

    def twice(*args):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return measured(*args)

    monkeypatch.setattr(shards, "_measured", twice)
    with pytest.raises(KeyboardInterrupt):
        shards.export_shards(rows, ["id"], path, 8, waves=4)
    monkeypatch.setattr(shards, "_measured", measured)
    manifest = shards.export_shards(rows, ["id"], path, 8, waves=4)
    assert manifest.count() == 8
    stored = spark.read.parquet(f"{path}/rows")
    assert stored.count() == 500 and all(r["intact"] for r in shards.shards_with(stored, manifest, ["id", "text"]).collect())
    assert shards.export_shards(rows, ["id"], path, 8).count() == 8 and spark.read.parquet(f"{path}/rows").count() == 500
    few = shards.export_shards(rows.limit(2), ["id"], str(tmp_path / "few"), 8)
    assert few.agg(F.sum("rows")).first()[0] == 2
    assert shards.export_shards(rows.limit(0), ["id"], str(tmp_path / "none"), 8).count() == 0


TEXTS = [
    "The MUSLIM man", "muslims", "a muslim.", "black-listed", "blacklist", "it's black", "C++ and c#", "x c++y", "STRASSE straße", "İstanbul ıI",
    "日本 人", "日本人", "", None, "disabled-person here", "__black__", "black_", "naïve NAÏVE", "trans gay lesbian", "q c++", "c++", "#tag #tag2",
]
GROUPS = {
    "faith": ["Muslim", "jewish "], "colour": ["black", "BLACK"], "code": ["c++", "#tag", "c#"], "place": ["straße", "istanbul", "ıi"],
    "asia": ["日本", "人"], "blank": [" "], "more": ["naïve", "disabled-person", "trans gay"],
}


def test_automaton_agrees_with_the_patterns(spark):
    rng = random.Random(5)
    pieces = ["black", "Muslim", "c++", "#tag", "日本", " ", "-", "_", ".", "x", "trans gay", "ß", "É"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    both = frame.select("id", "text", slices_of(F.coalesce("text", F.lit("")), GROUPS).alias("a"), term_slices(F.coalesce("text", F.lit("")), GROUPS).alias("b"))
    assert [(r["text"], r["a"], r["b"]) for r in both.collect() if r["a"] != r["b"]] == []
    assert term_slice_rows(frame.filter("text IS NULL"), GROUPS).select("slice").first()[0] == "no_identity_mention"
    assert TermAutomaton({"none": [" "]}).groups_of("black") == []


def test_many_terms_take_little_longer_than_few():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(10_000)]
    text = " ".join(rng.choice(words) + "x" for _ in range(200_000))
    took = []
    for n in (40, 10_000):
        automaton = TermAutomaton({"g": words[:n], "never": ["zzzz"]})
        start = time.perf_counter()
        automaton.groups_of(text)
        took.append(time.perf_counter() - start)
    assert took[1] < 4 * took[0] + 0.2


def test_batches_of_like_lengths(spark):
    rng = np.random.default_rng(8)
    lengths = rng.lognormal(5, 1, 5000).astype(int)
    padded = []
    for reorder in (0, 4096):
        batches = list(scoring.batch_places(lengths, 64, reorder))
        assert sorted(np.concatenate(batches)) == list(range(5000)) and max(map(len, batches)) <= 64
        padded.append(sum(len(b) * lengths[b].max() for b in batches))
    assert padded[1] < padded[0] / 2

    def load():
        return lambda texts: np.array([[len(t), int(hashlib.sha1(t.encode()).hexdigest()[:4], 16)] for t in texts], float)

    rows = [(i, None if i % 9 == 0 else "x" * int(n)) for i, n in enumerate(lengths[:300])]
    frame = spark.createDataFrame(rows, "id int, text string")
    in_order, sorted_ = (
        {r["id"]: r["p"] for r in scoring.BatchScorer("s", ["a", "b"], load, 16, reorder).score(frame, "text", "p").collect()}
        for reorder in (0, 50)
    )
    assert in_order == sorted_


def test_worst_cases_are_exactly_k(spark):
    rows = [(None, "no id", [1.0], [0.0]), (None, "no id either", [1.0], [0.0]), (5, "same", [1.0], [0.1]), (5, "same", [1.0], [0.1]), (5, "other", [1.0], [0.1]), (7, "well", [1.0], [1.0])]
    frame = spark.createDataFrame(rows, "id int, text string, labels array<double>, probs array<float>").repartition(3)
    for k in range(8):
        found = errors.worst_cases(frame, ["toxic"], 0.5, k).collect()
        assert len(found) == min(k, 6)
    assert [round(r["max_abs_error"], 1) for r in found] == [1.0, 1.0, 0.9, 0.9, 0.9, 0.0]
