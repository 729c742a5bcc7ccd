"""Leak scan, overfit flags and newest artefacts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modspark import constants as K


def _filled(value: Column) -> Column:
    return F.coalesce(F.length(F.trim(F.regexp_replace(value, f"[{K.SPACE_CHARS}]+", " "))) > 0, F.lit(False))


def _leak_tests(
    dtype: T.DataType, value: Column, path: str, keys: Sequence[str]
) -> Iterator[tuple[str, Column]]:
    """A test per place below ``value`` where a forbidden key could hold text."""
    if isinstance(dtype, T.StructType):
        for field in dtype.fields:
            inner, here = value.getField(field.name), f"{path}.{field.name}" if path else field.name
            if field.name in keys and isinstance(field.dataType, T.StringType):
                yield here, _filled(inner)
            else:
                yield from _leak_tests(field.dataType, inner, here, keys)
    elif isinstance(dtype, T.ArrayType):
        yield from _inside(dtype.elementType, value, f"{path}[]", keys)
    elif isinstance(dtype, T.MapType):
        if isinstance(dtype.keyType, T.StringType) and isinstance(dtype.valueType, T.StringType):
            for key in keys:
                yield f"{path}.{key}", _filled(F.try_element_at(value, F.lit(key)))
        yield from _inside(dtype.valueType, F.map_values(value), f"{path}{{}}", keys)


def _inside(
    dtype: T.DataType, items: Column, path: str, keys: Sequence[str]
) -> Iterator[tuple[str, Column]]:
    if not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return
    # the places are fixed by the schema; the test itself runs on each element
    places = [p for p, _ in _leak_tests(dtype, F.lit(None).cast(dtype), path, keys)]

    def leaks(i: int) -> Column:
        return F.exists(items, lambda x: list(_leak_tests(dtype, x, path, keys))[i][1])

    for i, place in enumerate(places):
        yield place, F.coalesce(leaks(i), F.lit(False))


def leak_scan(df: DataFrame, keys: Sequence[str] = K.RAW_TEXT_KEYS) -> DataFrame:
    """``path, n_leaks`` for every nested place that could hold raw text, in one aggregate."""
    tests = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in keys and isinstance(field.dataType, T.StringType):
            tests.append((field.name, _filled(value)))
        else:
            tests.extend(_leak_tests(field.dataType, value, field.name, keys))
    if not tests:
        return df.sparkSession.createDataFrame([], "path string, n_leaks long")
    one = df.agg(*[F.count_if(test).alias(f"c{i}") for i, (_, test) in enumerate(tests)])
    cells = [
        F.struct(F.lit(path).alias("path"), F.col(f"c{i}").alias("n_leaks"))
        for i, (path, _) in enumerate(tests)
    ]
    return one.select(F.inline(F.array(*cells)))


def has_leak(df: DataFrame, keys: Sequence[str] = K.RAW_TEXT_KEYS) -> bool:
    return bool(leak_scan(df, keys).filter("n_leaks > 0").take(1))


TRACKED_METRICS = ("eval_f1_micro", "eval_f1_macro", "eval_auc_macro")


def overfit_flags(
    log: DataFrame,
    run: str = "run",
    step: str = "step",
    rebound: float = 1.02,
    max_gap: float = 0.3,
    max_drop: float = 0.01,
) -> DataFrame:
    """``run, loss_rebound, loss_gap, metric_drop, overfit`` and the figures behind them.

    Last values come from max_by aggregates, so a long run is reduced before the shuffle;
    the value before the last is a second such aggregate over the steps before it.
    """
    # a null value takes no part: its order is null
    def last(value: str) -> Column:
        return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(step)))

    metrics = [m for m in TRACKED_METRICS if m in log.columns]
    best = F.max("best_metric") if "best_metric" in log.columns else F.lit(None).cast("double")
    ends = log.groupBy(run).agg(
        F.count("loss").alias("n_train"),
        F.count("eval_loss").alias("n_eval"),
        last("loss").alias("last_loss"),
        F.max(F.when(F.col("loss").isNotNull(), F.col(step))).alias("last_step"),
        F.min("eval_loss").alias("min_eval_loss"),
        last("eval_loss").alias("last_eval_loss"),
        (F.coalesce(*[last(m) for m in metrics]) if metrics else F.lit(None).cast("double")).alias(
            "last_metric"
        ),
        best.alias("best_metric"),
    )
    earlier = (
        log.filter(F.col("loss").isNotNull())
        .select(run, step, "loss")
        .join(ends.select(run, "last_step"), run)
        .filter(F.col(step) < F.col("last_step"))
        .groupBy(run)
        .agg(F.max_by("loss", step).alias("previous_loss"))
    )
    out = ends.join(earlier, run, "left")
    no = F.lit(False)
    flags = {
        "loss_rebound": F.coalesce(
            (F.col("n_train") >= 2)
            & (F.col("n_eval") >= 3)
            & (F.col("last_eval_loss") > F.col("min_eval_loss") * rebound)
            & (F.col("last_loss") < F.col("previous_loss")),
            no,
        ),
        "loss_gap": F.coalesce(F.col("last_eval_loss") - F.col("last_loss") > max_gap, no),
        "metric_drop": F.coalesce(F.col("best_metric") - F.col("last_metric") > max_drop, no),
    }
    out = out.withColumns(flags)
    overfit = F.col("loss_rebound") | F.col("loss_gap") | F.col("metric_drop")
    return out.withColumn("overfit", overfit).select(
        run,
        "min_eval_loss",
        "last_eval_loss",
        "last_loss",
        "previous_loss",
        "last_metric",
        "best_metric",
        *flags,
        "overfit",
    )


def latest_artifacts(runs: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """``kind, run_name, payload`` of the newest run per kind; an absent kind has nulls.

    Run names carry their time stamp, so the greatest name is the newest.
    """
    newest = runs.groupBy("kind").agg(
        F.max("run_name").alias("run_name"), F.max_by("payload", "run_name").alias("payload")
    )
    listed = runs.sparkSession.createDataFrame([(k,) for k in kinds], "kind string")
    return listed.join(newest, "kind", "left")
