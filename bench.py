"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
cores. Every query is run to the end into a sink that keeps nothing; planning
and whatever a query writes on the way count as its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from docketframe.session import local_session
from workloads.queries import QUERIES

HEADLINE = [
    "clean_text_documents",
    "normalize_dates",
    "split_names",
    "format_events",
    "events_primary_cont",
    "explode_attorneys",
    "attorney_rows",
    "dedup_rows",
    "stable_sort_rank",
    "page_refs",
    "skip_done",
    "case_numbers_listing",
    "case_numbers_dedup_count",
    "listed_refs",
    "attorney_rows_from_pages",
    "incremental_pages",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    spark = local_session(cores, cores)
    QUERIES["skip_done"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not measured
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
