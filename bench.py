"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. Every query is built,
planned and run to its last row with nothing cached; the result goes to the ``noop`` sink. The
reported time of a query is the best of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from rollbook.session import build_session

HEADLINES = (
    "stg_companies",
    "stg_establishments",
    "stg_partners",
    "stg_simples",
    "int_company_profile",
    "int_establishment_activity",
    "int_partner_metrics",
    "int_active_company_base",
    "dim_cnaes",
    "dim_companies",
    "dim_establishments",
    "fct_active_companies",
    "fct_active_companies_from_base",
    "window_representative",
    "agg_distinct",
    "incremental_second_batch",
    "scd2_second_release",
    "dedupe_current_state",
    "dq_suite",
    "serve_active_by_state_activity",
    "ingest_multi_archive",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__sql__session__timeZone="UTC",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        seconds[name] = round(best, 3)
        print(f"{name:36} {best:7.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
