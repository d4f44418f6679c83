"""The physical plans are the ones meant: shuffles, pushed filters, pruned columns and folders."""

import re

import pytest
from conftest import day
from pyspark.sql import functions as F

from daytally import schemas
from daytally.operators import daily_delta, pair_totals
from daytally.plans import dims, facts
from daytally.sinks import read_table, write_table
from verification.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    rows = [(f"1/{n}/2024", c, "p", "", "", t, n, 1, c) for c in ("A", "Brazil")
            for t in ("Confirmed", "Deaths") for n in range(1, 6)]
    path = str(tmp_path_factory.mktemp("landed") / "world")
    facts.with_day(spark.createDataFrame(rows, schemas.WORLD)).write.parquet(path)
    return spark.read.parquet(path)


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("how, expected", [("lag", 1), ("range", 1), ("join", 2)])
def test_shuffles_of_the_increment_forms(spark, landed, how, expected):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    no_broadcast(spark)
    try:
        df = daily_delta(landed, facts.WORLD_KEYS, "day", ["cases"], how)
        assert shuffles(df) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pair_totals_combines_before_its_one_shuffle(landed):
    df = pair_totals(landed, facts.WORLD_KEYS, "day", ["cases"])
    text = plan(df)
    assert shuffles(df) == 1 and "partial_sum" in text.split("Exchange hashpartitioning")[1]
    assert "hashpartitioning(case_type" in text and "day" in text.split("hashpartitioning")[1][:120]


def test_world_fact_reads_five_columns_once_and_filters_in_the_scan(landed):
    text = plan(facts.world_country(landed, how="lag"))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    assert len(scans) == 1
    assert sorted(c.split("#")[0] for c in scans[0].split(",")) == [
        "case_type", "cases", "combined_key", "country_region", "day"]
    assert "EqualTo(case_type,Confirmed)" in text and "IsNotNull(day)" in text


def test_as_of_slice_reaches_the_scan(landed):
    text = plan(dims.dim_country(landed, day(3)))
    assert "EqualTo(day,2024-01-03)" in text and "EqualTo(case_type,Deaths)" in text


def test_written_tables_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(c, day(n), 1, 1, 1, 1) for c in "ab" for n in range(1, 4)], schemas.FACT_COUNTRY)
    write_table(df, path, ["country_name", "date"])
    read = read_table(spark, path, schemas.FACT_COUNTRY).where(
        (F.col("country_name") == "a") & (F.col("date") >= F.lit(day(2))))
    text = plan(read)
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "country_name" in pruned and "date" in pruned and read.count() == 2


@pytest.mark.parametrize("name", ["fact_country_all", "fact_province_all", "compare_countries",
                                  "spread", "quality_counts", "fact_world_customers_join"])
def test_no_cross_joins_or_python_in_the_plans(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text
