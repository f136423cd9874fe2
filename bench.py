"""Time the headline queries; prints one JSON line.

``queries`` times each registered query over the raw test tables, so it
includes deriving the platform tables.  ``stored`` times the same operators
over platform tables written to Parquet once, which is how they are used.
Seconds are the median of ``BENCH_RUNS`` runs after two warm-ups.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from showlake.plans.change_queries import CHANGES
from showlake.plans.queries import READS
from showlake.sources.derive import platform_tables, store_platform_tables

HEADLINE = [
    "b01_top_watched",
    "b02_genre_hours",
    "b27_favourite_genre",
    "k05_kids_home",
    "r11_continue_watching",
    "r31_admin_content_list",
    "a01_title_engagement",
    "a06_cancellations_mom",
    "a11_monthly_revenue",
    "a22_search_conversion",
    "d01_merge_upsert",
    "d01_merge_upsert_small",
    "d13_delete_cascade",
]


def timed(build) -> float:
    def once() -> float:
        start = time.perf_counter()
        frame: DataFrame = build()
        frame.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for _ in range(2):  # warm-up
        once()
    return round(statistics.median(once() for _ in range(int(os.environ.get("BENCH_RUNS", "3")))), 3)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = {**READS, **CHANGES}
    queries = {name: timed(lambda q=every[name]: q(platform_tables(spark, directory))) for name in HEADLINE}
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    begin = time.perf_counter()
    tables = store_platform_tables(spark, directory, f"{scratch}/tables")
    store = round(time.perf_counter() - begin, 3)
    stored = {name: timed(lambda q=every[name]: q(tables)) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "stored": stored,
                "stored_total": round(sum(stored.values()), 3),
                "store_platform_tables": store,
            }
        )
    )


if __name__ == "__main__":
    main()
