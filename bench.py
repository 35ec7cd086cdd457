"""Times the headline queries once each and prints one JSON line.

BENCH_SF_DIR  folder of parquet tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local cores                (default 8)
BENCH_QUERIES comma-separated names      (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorespark.plans import catalog  # noqa: E402
from scorespark.session import drop_staged, finish, spark_session  # noqa: E402

HEADLINE = (
    "source_applicants",
    "dataset_hash",
    "split_assign",
    "impute_median",
    "scale_features",
    "features_flags_train",
    "auc_gini_ks",
    "feature_auc",
    "band_summary",
    "decisions",
    "woe_table",
    "iv_table",
    "reliability",
    "shap_linear",
    "psi_features",
    "psi_weekly",
    "latency_percentiles",
    "retrain_join",
    "shadow_migration",
    "gate",
    "stream_scores",
    "stream_weekly",
    "platt_scorecard",
    "rf_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    seconds = {}
    for name in names:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        drop_staged(spark)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    finish(spark)


if __name__ == "__main__":
    main()
