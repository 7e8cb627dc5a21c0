"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores. Each query
is planned and run in full twice, every row going to a sink that discards it, and the better time counts. ``planning``
has the part of it until the query is optimised, and ``load`` the machine's load when the bench began.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from careflow.session import build_session  # noqa: E402
from careflow.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "ods_decode",
    "config_latest",
    "dim_route",
    "dim_upsert_latest",
    "dim_store",
    "fact_consultation",
    "fact_prescription",
    "fact_prescription_paid_wide",
    "first_detail_per_prescription",
    "first_review_flag",
    "summary_consultation",
    "summary_consultation_paid",
    "summary_prescription",
    "summary_prescription_paid_daily",
    "summary_user_register",
    "summary_reviews",
    "tumbling_keyed",
    "stream_tumbling",
    "stream_fact_prescription",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("careflow-bench", master=f"local[{cores}]", zone="UTC")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["summary_consultation"](spark, folder).count()
    load = os.getloadavg()[0]
    times, planning = {}, {}
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            query = QUERIES[name](spark, folder)
            query._jdf.queryExecution().optimizedPlan()
            planned = time.perf_counter() - start
            query.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = (took, planned) if best is None else min(best, (took, planned))
        times[name], planning[name] = round(best[0], 3), round(best[1], 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "planning": planning,
                "load": round(load, 2),
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
