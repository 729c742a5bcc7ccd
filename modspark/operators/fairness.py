"""Metrics per identity slice and gaps against texts without identity terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modspark import constants as K
from modspark.functions.slices import Groups, slice_names, slices_of
from modspark.operators.errors import group_frame
from modspark.operators.metrics import evaluate_labels, rates, summarize, to_long


def slice_rows(df: DataFrame, groups: Groups, text: str = "text") -> DataFrame:
    """One row per row and slice it belongs to.

    No row is without a slice. The outer form of explode keeps Spark from adding a filter
    on the array, which would run every pattern a second time.
    """
    return df.withColumn("slice", F.explode_outer(slices_of(F.col(text), groups)))


def slice_long(
    df: DataFrame, groups: Groups, label_fields: Sequence[str], text: str = "text"
) -> DataFrame:
    """``slice, label, y, p``; the text is dropped before rows multiply."""
    slices = slices_of(F.coalesce(F.col(text), F.lit("")), groups).alias("slices")
    narrow = df.select(slices, "labels", "probs")
    return to_long(narrow.select(F.explode_outer("slices").alias("slice"), "labels", "probs"), label_fields, ["slice"])


def slice_labels(
    df: DataFrame,
    groups: Groups,
    label_fields: Sequence[str],
    threshold: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """``slice, label, n, positives, prevalence, tp, fp, fn, tn, auc, tpr, fpr``.

    Slices nobody falls into stay, with zeros and a null AUC.
    """
    found = evaluate_labels(slice_long(df, groups, label_fields, text), ["slice"], threshold)
    listed = group_frame(df, slice_names(groups), "slice").select(
        "slice", F.explode(F.array(*[F.lit(x) for x in label_fields])).alias("label")
    )
    counts = ["n", "positives", "tp", "fp", "fn", "tn"]
    full = listed.join(found, ["slice", "label"], "left").select(
        "slice", "label", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "auc"
    )
    share = F.coalesce(F.try_divide("positives", "n"), F.lit(0.0))
    return rates(full.withColumn("prevalence", share))


def slice_metrics(per_label: DataFrame) -> DataFrame:
    """``slice, n, f1_micro, f1_macro, auc_macro``; metrics of an empty slice are null."""
    out = summarize(per_label, ["slice"])
    kept = [F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("f1_micro", "f1_macro", "auc_macro")]
    return out.select("slice", "n", *kept)


def _gaps(df: DataFrame, on: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Difference of each measure from the reference slice, for non-empty slices.

    The table has a row per slice and label at most, so a window beside it costs nothing,
    and the metrics are computed once for both sides.
    """
    is_ref = F.col("slice") == K.REFERENCE_SLICE
    w = Window.partitionBy(*on)
    ref_size = F.max(F.when(is_ref, F.col("n"))).over(w)
    gaps = {
        f"{m}_gap": F.col(m) - F.max(F.when(is_ref, F.col(m))).over(w) for m in measures
    }
    out = df.withColumns({**gaps, "_ref_size": ref_size})
    kept = out.filter(~is_ref & (F.col("n") > 0) & (F.col("_ref_size") > 0))
    return kept.select("slice", *on, *gaps)


def label_gaps(per_label: DataFrame) -> DataFrame:
    """``slice, label, tpr_gap, fpr_gap``."""
    return _gaps(per_label, ["label"], ["tpr", "fpr"])


def metric_gaps(per_slice: DataFrame) -> DataFrame:
    """``slice, f1_micro_gap, auc_macro_gap``; a missing AUC gives a null gap."""
    keyed = per_slice.withColumn("one", F.lit(1))
    return _gaps(keyed, ["one"], ["f1_micro", "auc_macro"]).drop("one")
