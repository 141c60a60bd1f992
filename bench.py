"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query starts without cached tables; its result is computed whole and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acreline.queries import QUERIES  # noqa: E402
from acreline.session import local_session  # noqa: E402

HEADLINE = (
    "scan_table",
    "json_payload_rows",
    "contract_failures",
    "contract_summary",
    "clean_stats",
    "ratio_features",
    "describe_numeric",
    "histogram",
    "corr_matrix",
    "box_stats",
    "category_share",
    "profile_duplicates",
    "stratified_split",
    "stratified_kfold",
    "split_audit",
    "impute_median",
    "feature_matrix",
    "feature_matrix_full",
    "regression_metrics",
    "metrics_by_fold",
    "train_random_forest",
    "train_boosted_trees",
    "batch_predict",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["clean_stats"](spark, sf_dir).collect()  # start-up is not part of any query
    seconds = {}
    for name in names:
        spark.catalog.clearCache()
        start = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
