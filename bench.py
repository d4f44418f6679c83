"""Times the headline queries and prints one JSON line.

Each query is run once to warm up, then timed ``BENCH_RUNS`` times; its figure is the median.
Rows go to Spark's ``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "delta_lag", "delta_range", "delta_join_long", "delta_pair_totals",
    "fact_world_country", "fact_world_country_join", "fact_world_country_bykey",
    "fact_world_customers", "fact_world_customers_join", "fact_world_customers_bykey",
    "fact_brazil_province", "fact_brazil_country", "fact_usa_province", "fact_usa_country",
    "fact_country_all", "fact_province_all",
    "dim_country", "dim_province", "dim_time",
    "dedup_rows", "distinct_join", "count_distinct", "quality_counts",
    "compare_countries", "spread", "mortality_rate", "percent_increase",
    "scan_csv", "snapshot_raw", "sink_overwrite", "lake_build_country",
]


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds, headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
