"""Whole reports: several result tables from one scored frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from modspark.functions.slices import Groups
from modspark.operators import errors, fairness, metrics, thresholds

Report = dict[str, DataFrame]


def error_report(
    scored: DataFrame,
    label_fields: Sequence[str],
    threshold: float = 0.5,
    top_k: int = 50,
    order: Sequence[str] = ("id",),
) -> Report:
    """Metrics, confusion counts, feature summaries and worst cases; no text in any of them."""
    per_label = metrics.evaluate_labels(metrics.to_long(scored, label_fields), threshold=threshold)
    return {
        "overall": metrics.summarize(per_label),
        "confusion": per_label,
        "features": errors.feature_summary(scored, label_fields, threshold),
        "cases": errors.worst_cases(scored, label_fields, threshold, top_k, order),
    }


def fairness_report(
    scored: DataFrame, groups: Groups, label_fields: Sequence[str], threshold: float = 0.5
) -> Report:
    """Slices, their metrics and the gaps against texts without identity terms."""
    per_label = fairness.slice_labels(scored, groups, label_fields, threshold)
    per_slice = fairness.slice_metrics(per_label)
    return {
        "labels": per_label,
        "slices": per_slice,
        "label_gaps": fairness.label_gaps(per_label),
        "metric_gaps": fairness.metric_gaps(per_slice),
    }


def threshold_report(scored: DataFrame, label_fields: Sequence[str]) -> Report:
    counts = thresholds.grid_counts(metrics.to_long(scored, label_fields))
    return {
        "per_label": thresholds.best_per_label(counts),
        "global": thresholds.best_global(counts),
    }


def save_all(
    scored: DataFrame,
    builders: Mapping[str, Callable[[DataFrame], Report]],
    save: Callable[[DataFrame, str], None],
) -> None:
    """Build several reports from one frame that is scored once and kept while they run."""
    scored = scored.persist()
    try:
        for name, build in builders.items():
            for part, table in build(scored).items():
                save(table, f"{name}/{part}")
    finally:
        scored.unpersist()
