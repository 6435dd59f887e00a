"""Benchmark the headline queries.

Runs each query fully (``write.format("noop")``: every row is computed, none
is collected) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cpu_mem_report",
    "disk_report_nearest",
    "disk_report_bucket",
    "capacity_fill_rate",
    "readable_history",
    "host_item_catalog",
    "latest_per_item",
    "diag_presence",
    "normalize_records",
    "agent_node_rows",
    "route_strict_quarantine",
    "node_info",
    "staged_history_roundtrip",
    "dedup_history",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hostlake.session import local_session
    from hostlake.registry import QUERIES

    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # optional: stage / task times (local_session reads it)
    if log_dir:
        os.makedirs(log_dir, exist_ok=True)
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="hostlake-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM, class loading and the parquet footer cache, not timed
    QUERIES["readable_history"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the others
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        **({"failed": failed} if failed else {}),
    }))


if __name__ == "__main__":
    main()
