"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input
and the cores. Every result is computed in full and discarded by the executors.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimwright.session import session  # noqa: E402
from verification.queries import PLAIN  # noqa: E402

HEADLINES = [
    "policy_analytics", "claim_count_audit", "preparation_summary", "portfolio_kpis",
    "area_metrics", "driver_age_metrics", "top_regions", "largest_losses",
    "group_risk_summary", "quality_summary", "review_percentiles", "claims_table",
    "constraint_violations", "risk_deciles", "occurrence_split", "severity_split",
    "occurrence_metrics", "precision_recall_curve", "threshold_grid", "capacity_analysis",
    "subgroup_metrics", "frequency_metrics", "frequency_deciles", "severity_segments",
    "tail_summary", "design_matrix", "logistic_metrics", "occurrence_model_comparison",
    "frequency_model_comparison", "severity_model_comparison", "permutation_importances",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    # Preparation writes the tables the other queries share, and starts the session's
    # code generator and readers; it has an entry of its own, so nothing goes uncounted.
    started = time.perf_counter()
    PLAIN["model_eligibility"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds["preparation"] = round(time.perf_counter() - started, 3)
    for name in sys.argv[1:] or HEADLINES:
        started = time.perf_counter()
        PLAIN[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
