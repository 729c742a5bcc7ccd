import numpy as np
import pytest
from pyspark.sql import functions as F

from modspark.config import SplitSettings
from modspark.operators import monitoring, order_stats, sampling


def percentiles(spark, groups, fractions):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    counts = order_stats.count_values(df, ["g"], "v")
    out = order_stats.exact_percentiles(counts, ["g"], "v", "w", fractions)
    return {r["g"]: r for r in out.collect()}


def test_percentiles(spark):
    rng = np.random.default_rng(7)
    groups = {
        "uniform": rng.random(501),
        "one": [3.25],
        "two": [-1.0, 4.0],
        "same": [2.0] * 40,
        "signs": rng.normal(0, 1e3, 400),
        "close": 1.7e9 + rng.random(300) * 1e-3,
        "wide": 10.0 ** rng.uniform(-200, 200, 333),
        "skewed": [0.0] * 500 + list(rng.random(10)),
        "counts": rng.integers(0, 30, 999),
        "negative": -rng.random(77),
    }
    fractions = [0.0, 0.1, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = percentiles(spark, groups, fractions)
    for name, values in groups.items():
        want = np.percentile(values, [100 * q for q in fractions])
        assert got[name]["n"] == len(values)
        np.testing.assert_allclose(got[name]["p"], want, rtol=1e-12, err_msg=name)
        assert got[name]["mean"] == pytest.approx(np.mean(values))


def test_cells_grow_with_values(spark):
    rng = np.random.default_rng(8)
    values = np.sort(np.concatenate([rng.normal(0, 1, 500), 2.0 ** rng.integers(-300, 300, 300), [0, 5e-324, 1e308, -1e308]]))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    cells = [r[0] for r in df.orderBy("i").select(order_stats.value_cell(F.col("v"))).collect()]
    assert cells == sorted(cells)


def test_latency(spark):
    values = [5.0, 1.0, 9.5, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "ms double")
    row = monitoring.latency_summary(df, "ms").first()
    assert row["n"] == 4
    assert [row["p50_ms"], row["p95_ms"], row["p99_ms"]] == pytest.approx(np.percentile(values, [50, 95, 99]))
    empty = monitoring.latency_summary(df.limit(0), "ms").first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0.0)


def labelled(spark, n=1000):
    rows = [(i, [float(i % 5 == 0), 0.0]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, labels array<double>").repartition(3)


@pytest.mark.parametrize("method", ["xxhash64", "sha256"])
def test_downsampling(spark, method):
    df = labelled(spark)
    out = sampling.downsample_negatives(df, 0.37, ["id"], method=method)
    ids = sorted(r["id"] for r in out.collect())
    positive = [i for i in ids if i % 5 == 0]
    assert positive == list(range(0, 1000, 5))
    assert len(ids) - len(positive) == int(800 * 0.37)
    again = sampling.downsample_negatives(df.repartition(7), 0.37, ["id"], method=method)
    assert sorted(r["id"] for r in again.collect()) == ids


def test_downsampling_limits(spark):
    df = labelled(spark, 100)
    assert sampling.downsample_negatives(df, 1.0, ["id"]).count() == 100
    assert sampling.downsample_negatives(df, 0.0, ["id"]).count() == 20
    assert sampling.downsample_negatives(df, 0.001, ["id"]).count() == 20
    assert sampling.downsample_negatives(df.filter("id % 5 = 0"), 0.5, ["id"]).count() == 20


def test_downsampling_copies(spark, tmp_path):
    """A third of all rows share one id; the count is exact all the same."""
    rows = [(7, [0.0])] * 300 + [(i, [0.0]) for i in range(600)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "id long, labels array<double>").repartition(5).write.parquet(path)
    df = spark.read.parquet(path)
    for ratio in (0.05, 0.2, 0.33, 0.5, 0.8, 0.97):
        out = sampling.downsample_negatives(df, ratio, ["id"])
        assert out.count() == int(900 * ratio), ratio
        assert out.select("id").distinct().count() <= 600


def test_cap_rows(spark):
    df = labelled(spark)
    small = {r["id"] for r in sampling.cap_rows(df, 10, ["id"]).collect()}
    more = {r["id"] for r in sampling.cap_rows(df, 500, ["id"]).collect()}
    assert len(small) == 10 and len(more) == 500 and small < more
    assert sampling.cap_rows(df, 5000, ["id"]).count() == 1000
    assert sampling.cap_rows(df, 0, ["id"]).count() == 0
    assert sampling.cap_rows(df, None, ["id"]) is df


def test_random_split(spark):
    df = spark.range(20000)
    first = sampling.random_split(df, ["id"])
    n = {r["split"]: r["count"] for r in first.groupBy("split").count().collect()}
    assert n["train"] == pytest.approx(18000, rel=0.02)
    assert n["validation"] == pytest.approx(1000, rel=0.15)
    grown = sampling.random_split(spark.range(30000).repartition(3), ["id"])
    assert first.exceptAll(grown).count() == 0
    none = sampling.random_split(df, ["id"], SplitSettings(0.9, 0.1, 0.0))
    assert {r[0] for r in none.select("split").distinct().collect()} == {"train", "validation"}
    with pytest.raises(ValueError):
        SplitSettings(0.9, 0.2, 0.1)


def test_supplied_splits(spark):
    rows = labelled(spark, 100)
    kept = sampling.supplied_or_resplit(rows, rows.limit(5), rows.limit(7), ["id"])
    assert {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()} == {"train": 100, "validation": 5, "test": 7}
    for validation, test in ((None, rows), (rows, rows.limit(0)), (rows.limit(0), rows)):
        assert sampling.supplied_or_resplit(rows, validation, test, ["id"]).count() == 100
    assert sampling.evaluation_split(kept).count() == 7
    assert sampling.evaluation_split(kept.filter("split <> 'test'")).count() == 5


def test_class_splits(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(["train"] * 50 + ["validation"] * 3 + ["test"] * 2 + ["odd"])], "id int, split string")
    assert sampling.class_splits(rows, ["id"]).count() == 55
    again = sampling.class_splits(rows.filter("split <> 'test'"), ["id"])
    assert again.count() == 54 and {r[0] for r in again.select("split").distinct().collect()} <= {"train", "validation", "test"}
    with pytest.raises(RuntimeError):
        sampling.class_splits(rows.filter("split <> 'train'"), ["id"])


def test_shuffle(spark):
    df = spark.range(50)
    order = [r["id"] for r in sampling.shuffled(df, ["id"], 1).collect()]
    assert sorted(order) == list(range(50)) and order != sorted(order)
    assert order == [r["id"] for r in sampling.shuffled(df.repartition(3), ["id"], 1).collect()]
    assert order != [r["id"] for r in sampling.shuffled(df, ["id"], 2).collect()]
