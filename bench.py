"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query gets one warm-up
and then the median of three runs into a sink that forces full evaluation.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from modspark.plans.catalogue import QUERIES  # noqa: E402
from modspark.session import local_session  # noqa: E402

HEADLINE = (
    "text_features",
    "redact_pii",
    "slice_membership",
    "moderate_batch",
    "evaluate",
    "threshold_per_label",
    "error_feature_summary",
    "worst_cases",
    "slice_gaps",
    "daily_report",
    "latency_summary",
    "drift",
    "rolling_f1",
    "downsample_negatives",
    "language_id",
    "tfidf_evaluation",
    "tune_grid",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # the given files are one row group each: deal their texts out to the cores
    spark.conf.set("modspark.spread", "true")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took = {}
    for name in names:
        run(name)
        took[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
