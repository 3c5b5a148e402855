"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the driver's tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
BENCH_RUNS     runs per query; the fastest counts, all are reported (default 2: the first one compiles)
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from altimart.queries import QUERIES  # noqa: E402
from altimart.session import local_session  # noqa: E402

HEADLINE = [
    "stg_bookings",
    "stg_loyalty_activity",
    "dim_routes",
    "dim_customers",
    "fct_flights",
    "fct_bookings",
    "fct_tickets",
    "route_performance",
    "customer_performance",
    "decision_layer",
    "kpi_ancillary_attach_rate",
    "q_compare_routes",
    "q_get_high_value_at_risk_customers",
    "q_get_unstructured_insights",
    "graph_customer_metrics",
    "q_get_owl_route_classification",
    "graph_disjoint_violations",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session()
    each = {name: [round(_run(spark, folder, name), 3) for _ in range(runs)] for name in names}
    times = {name: min(seconds) for name, seconds in each.items()}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": runs,
                "each_run": each,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


def _run(spark, folder: str, name: str) -> float:
    """From composing the query to having computed every column of every row."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
