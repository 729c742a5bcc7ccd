"""Multi-label evaluation over a long table of ``(keys, label, y, p)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.numbers import at_least, f1, ratio
from modspark.operators.order_stats import count_values, exact_percentiles, value_cell


def to_long(
    df: DataFrame,
    label_fields: Sequence[str],
    keys: Sequence[str] = (),
    labels: str = "labels",
    probs: str = "probs",
) -> DataFrame:
    """One narrow row per text and label: ``keys, label, y double, p float``."""
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.get(F.col(labels), F.lit(i)).cast("double").alias("y"),
                F.get(F.col(probs), F.lit(i)).cast("float").alias("p"),
            )
            for i, name in enumerate(label_fields)
        ]
    )
    return df.select(*keys, F.inline(cells))


def confusion_columns(threshold: float | Column, weight: Column | None = None) -> list[Column]:
    """Aggregates n, tp, fp, fn, tn at a threshold."""
    w = F.lit(1) if weight is None else weight
    truth, hit = F.col("y").cast("int"), at_least(F.col("p"), threshold)
    cases = {
        "tp": (truth == 1) & hit,
        "fp": (truth == 0) & hit,
        "fn": (truth == 1) & ~hit,
        "tn": (truth == 0) & ~hit,
    }
    total = F.sum(w).cast("long").alias("n")
    return [total] + [F.sum(F.when(c, w).otherwise(0)).cast("long").alias(k) for k, c in cases.items()]


def confusion(long: DataFrame, keys: Sequence[str] = (), threshold: float | Column = 0.5) -> DataFrame:
    """``keys, label, n, tp, fp, fn, tn``; one partial aggregate and a tiny shuffle."""
    return long.groupBy(*keys, "label").agg(*confusion_columns(threshold))


def f1_scores(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, f1_micro, f1_macro`` from per-label counts."""
    micro = f1(F.sum("tp"), F.sum("fp"), F.sum("fn"))
    macro = F.avg(f1(F.col("tp"), F.col("fp"), F.col("fn")))
    return counts.groupBy(*keys).agg(micro.alias("f1_micro"), macro.alias("f1_macro"))


def evaluate_labels(
    long: DataFrame, keys: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """``keys, label, n, positives, tp, fp, fn, tn, auc`` with exact ROC-AUC.

    Rows collapse to distinct scores first; counts at the threshold follow from the score.
    Each distinct score then meets the negatives below it in two steps: inside its score
    cell, and over the cells. Both steps are bounded by the 32-bit score, not by the
    number of rows.
    """
    by_label = [*keys, "label"]
    truth = F.col("y").cast("int")
    # a score or label the ranking is not defined for
    odd = F.col("p").isNull() | F.isnan("p") | ~F.col("y").isin(0.0, 1.0)
    by_score = long.groupBy(*by_label, "p").agg(
        F.count("*").alias("n"),
        F.count_if(truth == 1).alias("pos"),
        F.count_if(truth == 0).alias("neg"),
        F.count_if(odd).alias("odd"),
    )
    counts = ["n", "pos", "neg", "odd", "tp", "fp"]
    hit = at_least(F.col("p"), threshold)
    by_score = by_score.withColumns(
        {
            "cell": F.when(~F.isnan("p"), value_cell(F.col("p"))),
            "tp": F.when(hit, F.col("pos")).otherwise(0),
            "fp": F.when(hit, F.col("neg")).otherwise(0),
        }
    )
    pos = F.col("pos").cast("double")
    cells = (
        _negatives_below(by_score, [*by_label, "cell"], "p")
        .groupBy(*by_label, "cell")
        .agg(
            *[F.sum(c).alias(c) for c in counts],
            F.sum(pos * (F.col("lower") + F.col("neg") / 2)).alias("won"),
        )
    )
    total = (
        _negatives_below(cells, by_label, "cell")
        .groupBy(*by_label)
        .agg(
            *[F.sum(c).alias(c) for c in counts],
            F.sum(F.col("won") + pos * F.col("lower")).alias("won"),
        )
    )
    auc = F.when(F.col("odd") == 0, F.try_divide(F.col("won"), pos * F.col("neg")))
    return total.select(
        *by_label,
        "n",
        F.col("pos").alias("positives"),
        "tp",
        "fp",
        (F.col("pos") - F.col("tp")).alias("fn"),
        (F.col("neg") - F.col("fp")).alias("tn"),
        auc.alias("auc"),
    )


def _negatives_below(df: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("lower", F.coalesce(F.sum("neg").over(w), F.lit(0)))


def summarize(per_label: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, n, f1_micro, f1_macro, auc_macro``; labels without an AUC are left out of its mean."""
    return per_label.groupBy(*keys).agg(
        F.max("n").alias("n"),
        f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("f1_micro"),
        F.avg(f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("f1_macro"),
        F.avg("auc").alias("auc_macro"),
    )


def compare_models(long: DataFrame, models: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per listed model; a model without predictions is noted, not dropped."""
    found = summarize(evaluate_labels(long, ["model"], threshold), ["model"])
    note = F.when(F.col("n").isNull(), F.lit("no predictions")).otherwise(F.lit("")).alias("note")
    return models.join(found, "model", "left").select(
        "model", "n", "f1_micro", "f1_macro", "auc_macro", note
    )


def label_prevalence(df: DataFrame, label_fields: Sequence[str], labels: str = "labels") -> DataFrame:
    """``label, n, positive_rate`` in one aggregate without multiplying rows."""
    rates = [F.avg(F.get(F.col(labels), F.lit(i))).alias(f"r{i}") for i in range(len(label_fields))]
    one = df.agg(F.count("*").alias("n"), *rates)
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("label"), F.coalesce(F.col(f"r{i}"), F.lit(0.0)).alias("positive_rate"))
            for i, name in enumerate(label_fields)
        ]
    )
    return one.select("n", F.inline(cells)).select("label", "n", "positive_rate")


def positive_weights(
    df: DataFrame, label_fields: Sequence[str], labels: str = "labels"
) -> DataFrame:
    """``label, pos_weight`` = (negatives + 1) / (positives + 1); all ones if widths differ."""
    width = len(label_fields)
    sums = [F.sum(F.get(F.col(labels), F.lit(i))).alias(f"s{i}") for i in range(width)]
    one = df.agg(
        F.count("*").alias("n"), F.count_if(F.size(labels) != width).alias("odd"), *sums
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.when(
                    F.col("odd") == 0,
                    (F.col("n") - F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + 1)
                    / (F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + 1),
                )
                .otherwise(F.lit(1.0))
                .cast("float")
                .alias("pos_weight"),
            )
            for i, name in enumerate(label_fields)
        ]
    )
    return one.select(F.inline(cells))


def rates(counts: DataFrame) -> DataFrame:
    """Add true and false positive rates, 0 where undefined."""
    return counts.withColumns(
        {
            "tpr": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
            "fpr": ratio(F.col("fp"), F.col("fp") + F.col("tn")),
        }
    )


def split_summary(df: DataFrame) -> DataFrame:
    """``split, n_rows, clean, offensive, hate, avg_char_len, p95_char_len`` of three-class rows."""
    lengths = count_values(df, ["split"], "char_len")
    stats = exact_percentiles(lengths, ["split"], "char_len", "w", [0.95])
    counts = df.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        *[
            F.count_if(F.col("class_id") == i).alias(name.lower())
            for i, name in enumerate(K.CLASS_NAMES)
        ],
    )
    return counts.join(stats, "split", "left").select(
        "split",
        "n_rows",
        *[name.lower() for name in K.CLASS_NAMES],
        F.coalesce("mean", F.lit(0.0)).alias("avg_char_len"),
        F.coalesce(F.get("p", F.lit(0)).cast("int"), F.lit(0)).alias("p95_char_len"),
    )
