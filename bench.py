"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and three times measured; its figure is the
median. All result rows are computed (``noop`` sink).

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     1: every named query
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from cohortlens.plans.queries import QUERIES
from cohortlens.session import builder, sized_for

HEADLINE = [
    "agg_row_counts",
    "agg_global_mean",
    "dq_profile",
    "dq_unique_key",
    "dq_repeated_key",
    "silver_students",
    "silver_academic",
    "silver_attendance",
    "silver_socio",
    "silver_retention",
    "join_left_star",
    "join_hot_keys",
    "gold_student_risk_profile",
    "gold_attendance_vs_performance",
    "gold_dropout_trends",
    "gold_intervention_candidates",
    "gold_retention_overview",
    "ml_features",
    "ml_predictions",
    "ml_auc_rank",
    "pred_with_risk_topk",
    "alert_breakdown_sets",
    "alert_digest",
    "alert_institution_trend",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        builder("cohortlens-bench", **sized_for(1 << 30, cpus))
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
