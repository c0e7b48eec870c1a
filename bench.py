"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.plans import QUERIES, load_all  # noqa: E402
from rollcall.session import build_session, drop_scratch  # noqa: E402

HEADLINE = [
    "select_features",
    "prev_missed_features",
    "appointments_last_days",
    "appointments_same_day",
    "days_since_last",
    "dedup_keep_last",
    "clinic_rules",
    "star_extract",
    "eligibility_filter",
    "active_patient_semi",
    "haversine",
    "working_days",
    "call_list",
    "kpi_base",
    "call_outcome_kpis",
    "monthly_rate",
    "monthly_score_density",
    "quantile_bins",
    "bin_edges_per_group",
    "treatment_groups",
    "temporal_split",
    "roc_auc_exact",
    "monthly_auc",
    "calibration_curve",
    "daily_top_k",
    "upsert_predictions",
    "upsert_sensitive",
    "deactivate_outdated",
    "stream_score_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="rollcall-bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    names = sys.argv[1:] or HEADLINE
    # Executors are long-lived: let the JVM compile the code on the smallest tables
    # before the clock runs.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
