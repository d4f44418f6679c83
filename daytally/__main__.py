"""spark-submit entry: ``python -m daytally --world ... --lake ...``."""

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .plans.build import Sources, build_lake
from .plans.dims import POPULATION_DAY
from .schemas import LAYOUTS


def main() -> None:
    args = argparse.ArgumentParser(prog="daytally", description=__doc__)
    for name in ("world", "brazil", "provinces", "usa", "snapshot", "lake"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--as-of", type=dt.date.fromisoformat, default=POPULATION_DAY)
    args.add_argument("--since", type=dt.date.fromisoformat)
    args.add_argument("--layout", choices=sorted(LAYOUTS), default="day")
    args.add_argument("--corrected", action="store_true")
    args.add_argument("--increments", choices=["lag", "spread", "risen"], default="lag")
    got = args.parse_args()
    spark = SparkSession.builder.appName("daytally").getOrCreate()
    sources = Sources(got.world, got.brazil, got.provinces, got.usa)
    report = build_lake(
        spark, sources, got.snapshot, got.lake, got.as_of, got.since, got.corrected,
        got.layout, got.increments,
    )
    report.show(truncate=False)
    if report.where("not passed").count():
        sys.exit("the report has failed checks")


if __name__ == "__main__":
    main()
