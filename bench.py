"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query is evaluated
whole (all columns, all rows) into a sink that keeps nothing. The best of BENCH_REPEAT runs
counts, after one run that warms the JVM up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "h8_consolidated", "h8_consolidated_parts", "h8_consolidated_ties", "h3_replay",
    "h1_merge_complete", "h2_merge_partial", "h4_retired_aggregate", "h10_duplicate_versions",
    "h11_drop_duplicates", "h15_dead_links", "a1_area_counts", "a3_recently_deleted",
    "a11_weekly_series", "l3_first_seen", "l4_duplicate_links", "l7_discovery_totals",
    "x1_titles", "x7_list_fields", "i3_checksums", "i5_valid_records", "p2_markdown",
    "s6_full_parquet", "s8_min_csv",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = local_session(cores, cores, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = None
        for attempt in range(repeat + 1):
            started = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
            if attempt:
                best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
