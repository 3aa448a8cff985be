"""Bench: headline catalogue queries on one data set folder.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (``noop`` sink: every row is produced, nothing
is collected to the driver). One warm-up run, then the median of three runs.
Prints one JSON line. The headline flatten queries include building their
input documents from the tables; ``landed`` times the same flatteners on a
raw-documents parquet table written once beforehand (the production path:
land documents once, flatten from the table). Set BENCH_LANDED=0 to skip.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINE = ["wide_join", "coverage_counts", "reviews_flatten", "vintages_flatten",
            "prices_flatten", "resume_plan"]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from doclake import catalog
    from doclake.session import get_session

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    qs = catalog.queries()
    names = [n for n in (os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES")
                         else HEADLINE) if n in qs]

    def median_time(make_df) -> float:
        def once() -> float:
            t0 = time.perf_counter()
            make_df().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()
        return round(statistics.median(once() for _ in range(runs)), 3)

    timings: dict[str, float] = {}
    for name in names:
        timings[name] = median_time(lambda: qs[name](spark, root))

    landed: dict[str, float] = {}
    if os.environ.get("BENCH_LANDED", "1") != "0" and not os.environ.get("BENCH_QUERIES"):
        from doclake.catalog.render import price_docs, review_docs, wines_docs
        from doclake.operators import flatten as FL
        from doclake.session import scratch_path
        for name, render, flatten in (("reviews_flatten", review_docs, FL.flatten_reviews),
                                      ("vintages_flatten", wines_docs, FL.flatten_vintages),
                                      ("prices_flatten", price_docs, FL.flatten_prices)):
            path = scratch_path(spark, f"bench-raw-{name}")
            render(spark, root).write.parquet(path)
            landed[name] = median_time(lambda: flatten(spark.read.parquet(path)))
    m = re.search(r"sf([0-9.]+)", root)
    print(json.dumps({
        "metric": "sum_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "landed": landed,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
