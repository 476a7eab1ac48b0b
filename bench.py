"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2; the
fastest run counts), BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vanewatch.plans import catalog
from vanewatch.session import build_session

HEADLINE = (
    "virtual_ordinal",
    "rul_label",
    "minmax_batch",
    "minmax_clamped",
    "silver_train",
    "group_split",
    "sliding_sequences",
    "last_sequence_padded",
    "running_max_dedupe",
    "arrival_windows",
    "validation_report",
    "linear_score",
    "fleet_top_risk",
    "ensemble_confidence",
    "alert_dedupe",
    "engine_status",
    "classification_report",
    "error_histogram",
    "ks_p_values",
    "counter_rate",
    "histogram_quantile",
    "latency_quantiles",
    "sustained_alert",
    "stream_features",
    "rul_regressor_metrics",
    "forest_confidence",
    "stream_fleet_alerts",
    "stream_alert_dedupe",
    "raw_text_scan",
    "dead_letters",
    "rul_closed_form",
    "bootstrap_confidence",
    "latency_rule",
    "store_compacted",
    "stream_telemetry",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-warehouse-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["rul_label"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up

    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
