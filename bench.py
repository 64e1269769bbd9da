"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peervane.session import build_session
from workload import catalogue

HEADLINE = (
    "ded1_last_row_per_key",
    "scl8_triage",
    "agg18_metric_panel",
    "jn7_measured_fees",
    "jn10_filing_in_force",
    "agg6_eligibility_funnel",
    "agg8_exact_quantiles",
    "win6_average_rank",
    "ord4_top_five_per_profile",
    "sco7_twin_pairs",
    "sco9_gated_selection",
    "res3_thousand_draws",
    "res5_rank_stability",
    "bt3_random_portfolios",
    "bt5_evaluated_selections",
    "sco12_ranked_profiles",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM's code paths and the Python workers.
    catalogue.QUERIES["res3_resampled_metrics"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
