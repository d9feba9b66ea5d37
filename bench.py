"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs after one warm-up, of which the best counts (default 3)
BENCH_QUERIES comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import time

from txrisk.plans.queries import QUERIES
from txrisk.session import spark_session

HEADLINE = [
    "customer_features",
    "order_customer_features",
    "features_a",
    "features_b",
    "score_linear",
    "validate_tx",
    "profile_describe",
    "id_uniqueness",
    "value_counts",
    "histogram",
    "density_curve",
    "box_stats",
    "relation_checks",
    "shared_account_samples",
    "label_from_cluster",
    "training_set",
    "stratified_split",
    "roc_auc",
    "model_comparison",
]
# Iterative training is timed once, after the warm-up of the others.
TRAINING = ["rfm_clusters", "rf_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE + TRAINING
    spark = spark_session(
        "txrisk-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        # Frames kept by an earlier run must not serve this one.
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        if name in TRAINING:
            timings[name] = round(once(name), 3)
        else:
            once(name)
            timings[name] = round(min(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_best_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
