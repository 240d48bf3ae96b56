"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names; default the headline list).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workloads.registry import QUERIES  # noqa: E402

HEADLINE = [
    "scan_date_window",
    "spine_id",
    "prior_report",
    "ind_split",
    "clean_dataset",
    "null_profile",
    "mode_profile",
    "distinct_profile",
    "binary_columns",
    "merge_cleaned",
    "merge_windowed",
    "string_index",
    "dummies",
    "chi_square",
    "mutual_information",
    "quantile_buckets",
    "criterion_percentile",
    "deciles",
    "metrics_report",
    "ks_table",
    "ks_by_month",
    "eval_production",
    "audit_numeric",
    "audit_categorical",
    "report_performance",
    "feature_importance_rf",
    "train_gbt",
    "score_production",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    took = {}
    for name in names.split(",") if names else HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
