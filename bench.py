"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Each query runs once
to warm up, then ``BENCH_RUNS`` times, and the median counts. Training and streams run
last and once.
Results are forced with the ``noop`` sink, which computes every column of every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from windrow.checks.queries import catalog  # noqa: E402
from windrow.session import build_session  # noqa: E402

LIGHT = (
    "unit_conversion",
    "grid_extract",
    "raw_scan",
    "kafka_decode",
    "storage_summary",
    "bronze_table",
    "bronze_roundtrip",
    "silver_labeled",
    "silver_fallback",
    "gold_rolling",
    "gold_rolling_sliced",
    "gold_training_features",
    "rolling_by_supplier",
    "rolling_by_supplier_sliced",
    "price_quantile",
    "metrics_accuracy_f1",
    "metrics_auc",
    "top_runs",
)
ONCE = ("stream_raw_to_bronze", "stream_dual_sink", "rf_train_eval", "lr_train_eval", "experiment_grid")


def seconds(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, measured = catalog(), {}
    for name in LIGHT + ONCE:
        if name in LIGHT:
            seconds(queries[name], spark, sf_dir)
        times = [seconds(queries[name], spark, sf_dir) for _ in range(runs if name in LIGHT else 1)]
        measured[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
