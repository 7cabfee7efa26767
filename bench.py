"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablewright.plans.catalogue import QUERIES
from tablewright.session import local_session

# Audit, exploration, splitting, preparation, fits with held-out scores, neighbours, scoring.
HEADLINE = [
    "c1_column_audit",
    "c4_duplicate_rows",
    "c5_describe_all",
    "d1_histogram",
    "d4_correlation_matrix",
    "d9_box_statistics",
    "e2_stratified_hold_out",
    "e4_row_overlap",
    "e7_stratified_folds",
    "f2_f5_design_matrix",
    "j1_j3_regression_metrics",
    "j4_j9_classification_metrics",
    "g1_linear_regression",
    "g2_ridge",
    "g3_lasso",
    "g5_polynomial",
    "g6_decision_tree",
    "h3_gaussian_bayes",
    "h4_decision_tree",
    "h2_nearest_neighbours",
    "i8_stream_scoring",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
