"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query runs to completion into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tablewright.catalog import QUERIES
from tablewright.session import get_session

HEADLINE = [
    "fit_multilabel",
    "cross_validate",
    "tuned_logreg_metrics",
    "tree_model_metrics",
    "risk_metrics",
    "evaluate_model",
    "auc_roc",
    "describe_numeric",
    "five_number_by_class",
    "correlation_matrix",
    "histogram_by_class",
    "class_balance",
    "rate_by_group",
    "term_frequency",
    "idf",
    "tf_idf",
    "hashed_tf_idf",
    "score_linear_long",
    "string_index",
    "apply_index",
    "one_hot",
    "clean_table",
    "split_train_test",
    "multi_label_fan_in",
    "scan_csv_text",
]

WARM_UP = ["class_balance", "score_held_out", "fit_decision_tree"]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = get_session("tablewright bench", cores)
    # Start the JVM's code paths on queries that are not timed.
    for name in WARM_UP:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
