"""Privacy-safe error analysis: group features and worst cases, never text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.functions.numbers import at_least
from modspark.functions.text import FEATURES, all_features, content_hash, feature
from modspark.operators.order_stats import exact_percentiles

CASE_FEATURES = (
    "length_chars",
    "length_words",
    "has_url",
    "has_email",
    "has_quote",
    "uppercase_ratio",
)


def _truth(labels: Column, i: int) -> Column:
    return F.get(labels, F.lit(i)).cast("int")


def _hit(probs: Column, i: int, threshold: float) -> Column:
    return at_least(F.get(probs, F.lit(i)), threshold).cast("int")


def any_error(
    label_fields: Sequence[str], threshold: float, labels: str = "labels", probs: str = "probs"
) -> Column:
    """Some label is predicted wrongly."""
    wrong = F.lit(False)
    for i in range(len(label_fields)):
        wrong = wrong | (_truth(F.col(labels), i) != _hit(F.col(probs), i, threshold))
    return wrong


def group_names(label_fields: Sequence[str]) -> list[str]:
    return ["all", "any_error"] + [f"{kind}:{x}" for x in label_fields for kind in ("fp", "fn")]


def error_groups(
    label_fields: Sequence[str], threshold: float, labels: str = "labels", probs: str = "probs"
) -> Column:
    """Array of the groups a row belongs to: all, any_error, fp:label, fn:label."""
    y, p = F.col(labels), F.col(probs)
    cases = [F.lit("all"), F.when(any_error(label_fields, threshold, labels, probs), F.lit("any_error"))]
    for i, name in enumerate(label_fields):
        truth, hit = _truth(y, i), _hit(p, i, threshold)
        cases.append(F.when((truth == 0) & (hit == 1), F.lit(f"fp:{name}")))
        cases.append(F.when((truth == 1) & (hit == 0), F.lit(f"fn:{name}")))
    return F.array_compact(F.array(*cases))


def group_frame(df: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """A small frame of fixed names, to keep empty groups in a report."""
    return df.sparkSession.createDataFrame([(n,) for n in names], f"{column} string")


def feature_summary(
    df: DataFrame,
    label_fields: Sequence[str],
    threshold: float,
    text: str = "text",
    labels: str = "labels",
    probs: str = "probs",
) -> DataFrame:
    """``grp, feature, n, mean, median, p90`` for every group, empty ones with n = 0.

    Rows collapse to counts per set of groups, feature and value before the groups are
    unfolded, so overlapping groups multiply counts and not texts.
    """
    groups = error_groups(label_fields, threshold, labels, probs).alias("groups")
    wide = df.select(groups, *all_features(F.col(text)))
    cells = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in FEATURES]
    )
    counts = (
        wide.select("groups", F.inline(cells))
        .groupBy("groups", "feature", "v")
        .agg(F.count("*").alias("w"))
        .select(F.explode("groups").alias("grp"), "feature", "v", "w")
        .groupBy("grp", "feature", "v")
        .agg(F.sum("w").alias("w"))
    )
    stats = exact_percentiles(counts, ["grp", "feature"], "v", "w", [0.5, 0.9])
    listed = group_frame(df, group_names(label_fields), "grp").select(
        "grp", F.explode(F.array(*[F.lit(f) for f in FEATURES])).alias("feature")
    )
    return listed.join(stats, ["grp", "feature"], "left").select(
        "grp",
        "feature",
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean",
        F.get("p", F.lit(0)).alias("median"),
        F.get("p", F.lit(1)).alias("p90"),
    )


def max_error(labels: str = "labels", probs: str = "probs") -> Column:
    """Largest distance between score and label, in 32-bit arithmetic."""
    return F.array_max(
        F.zip_with(labels, probs, lambda y, p: F.abs(p.cast("float") - y.cast("float")))
    )


def worst_cases(
    df: DataFrame,
    label_fields: Sequence[str],
    threshold: float,
    k: int = 50,
    order: Sequence[str] = ("id",),
    text: str = "text",
    labels: str = "labels",
    probs: str = "probs",
) -> DataFrame:
    """The ``k`` rows furthest from their labels as records without text; all if there are fewer.

    Each task keeps its own k best by scores alone; the k winners, a bounded table, then
    fetch their texts. ``order`` and then a hash of the text break ties and name a row; null
    ids come first and find their texts too, and rows that repeat count each.
    """
    hashed = df.withColumn("_hash", F.xxhash64(text))
    narrow = hashed.select(*order, "_hash", labels, probs, max_error(labels, probs).alias("max_abs_error"))
    best = narrow.orderBy(F.desc("max_abs_error"), *order, "_hash").limit(k)
    keys = [*order, "_hash"]
    won = best.groupBy(*keys).agg(F.collect_list(F.struct(labels, probs, "max_abs_error")).alias("_rows"))
    won = won.select(*[F.col(c).alias(f"_won_{c}") for c in keys], "_rows")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_won_{c}"))
    found = hashed.select(*keys, text).join(F.broadcast(won), same)
    found = found.groupBy(*keys).agg(F.min(text).alias(text), F.first("_rows").alias("_rows"))
    top = found.select(*order, text, F.inline("_rows"))
    top = top.repartition(1).sortWithinPartitions(F.desc("max_abs_error"), *order)
    names = F.array(*[F.lit(x) for x in label_fields])
    indexes = range(len(label_fields))
    raw = F.coalesce(F.col(text), F.lit(""))
    return top.select(
        content_hash(F.col(text)).alias("sha256"),
        *[feature(name, raw).alias(name) for name in CASE_FEATURES],
        F.col("max_abs_error"),
        F.map_from_arrays(
            names, F.array(*[(F.get(labels, F.lit(i)) > 0.5).cast("int") for i in indexes])
        ).alias("true_labels"),
        F.map_from_arrays(
            names, F.array(*[_hit(F.col(probs), i, threshold) for i in indexes])
        ).alias("pred_labels"),
        F.map_from_arrays(names, F.col(probs).cast("array<double>")).alias("pred_probs"),
    )
