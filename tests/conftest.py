import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(n: int) -> dt.date:
    """The n-th of January 2024, running on into later months."""
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def rows(df, *columns):
    """The rows as sorted tuples, None first."""
    got = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in got.collect()), key=lambda r: [(x is not None, x) for x in r])
