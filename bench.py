"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores;
``BENCH_QUERIES`` may name a comma-separated subset or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpuslink.plans.catalog import QUERIES  # noqa: E402
from corpuslink.session import local_session  # noqa: E402

HEADLINE = [
    "course_search_time_day",
    "course_search_terms_all",
    "course_search_walking",
    "prefix_counts",
    "prefix_decisions",
    "char_gram_counts",
    "language_attribution",
    "jw_levels",
    "linked_pairs_blocked",
    "links_resolved",
    "keyword_index",
    "link_crawl",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = local_session(cpus, int(cpus), "bench")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start-up is not part of any query
    times: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
