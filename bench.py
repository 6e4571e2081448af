"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_QUERIES (comma list or
"all"). Each query runs to completion into a sink that discards rows: once cold, then warm.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortspark.registry import QUERIES  # noqa: E402
from cohortspark.session import discard_written, get_session  # noqa: E402

HEADLINE = [
    "person_search_view", "visits_view", "visits_view_fanout", "visit_summary", "visit_notes", "person_all_notes",
    "build_person", "build_contact", "build_visit", "build_visit_study", "build_visit_task", "build_enroll",
    "build_note", "build_task", "build_visit_action", "dense_surrogate_key", "alias_key_lookup_visits", "remap_keys",
    "keep_first", "latest_per_key", "json_agg_distinct", "count_distinct", "pack_all_tables", "unpivot_values",
    "natural_left_join", "star_join_fanout", "register_visits", "reschedule_visits", "cancel_visits",
    "apply_latest_status", "stream_latest_status", "check_tables",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        cold[name] = timed(spark, name, folder)
        warm[name] = timed(spark, name, folder)
    discard_written(spark)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "sf": float(sf.group(1)) if sf else folder, "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
