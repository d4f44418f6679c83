import os

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from daytally import schemas
from daytally.sinks import read_table, scratch_dir, with_month, write_clustered, write_table

FACT = "country_name string, date date, confirmed_cases bigint, death_cases bigint, " \
       "sum_confirmed_cases bigint, sum_death_cases bigint"


def fact(spark, days, start=0):
    return spark.createDataFrame(
        [(c, day(n), start + n, None, n, 1) for c in ("a*b", "c d", None) for n in days], FACT
    )


@pytest.mark.parametrize("tasks", [None, 3])
def test_round_trip_and_folders(spark, tmp_path, tasks):
    path = str(tmp_path / "t")
    df = fact(spark, [1, 2])
    write_table(df, path, ["country_name", "date"], tasks=tasks)
    back = read_table(spark, path, schemas.FACT_COUNTRY)
    assert back.schema == schemas.FACT_COUNTRY and rows(back) == rows(df)
    assert "country_name=c d" in os.listdir(path)
    assert os.listdir(f"{path}/country_name=c d").count("date=2024-01-01") == 1


def test_month_text_keeps_its_zero(spark, tmp_path):
    df = spark.createDataFrame(
        [("5/9/2020", "2020", 19, "05", "09", 7, day(1))], schemas.DIM_TIME)
    write_table(df, str(tmp_path / "t"), ["year", "month"])
    assert rows(read_table(spark, str(tmp_path / "t"), schemas.DIM_TIME)) == rows(df)


def test_append_doubles_and_dynamic_does_not(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["country_name", "date"]
    write_table(fact(spark, [1, 2, 3]), path, by)
    for _ in range(2):
        write_table(fact(spark, [3, 4], start=100), path, by, "dynamic")
    want = rows(fact(spark, [1, 2]).unionByName(fact(spark, [3, 4], start=100)))
    assert rows(read_table(spark, path, schemas.FACT_COUNTRY)) == want
    write_table(fact(spark, [4], start=100), path, by, "append")
    assert read_table(spark, path, schemas.FACT_COUNTRY).count() == len(want) + 3
    write_table(fact(spark, [9]), path, by)
    assert rows(read_table(spark, path, schemas.FACT_COUNTRY)) == rows(fact(spark, [9]))


def test_unknown_mode_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="mode must be"):
        write_table(fact(spark, [1]), str(tmp_path / "t"), ["date"], "merge")


def test_large_folder_is_split_over_tasks(spark, tmp_path):
    """Two thirds of the rows share a folder; adaptive execution writes it from several tasks."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50))
        .alias("k"), F.rand(1).alias("v"), F.col("id"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256kb")
    try:
        write_table(df, str(tmp_path / "t"), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(tmp_path / "t" / "k=hot") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("id")).first()[0] == 299_999 * 150_000


def test_month_layout(spark, tmp_path):
    df = with_month(fact(spark, [1, 31, 32]))
    write_table(df, str(tmp_path / "t"), ["country_name", "month"])
    back = read_table(spark, str(tmp_path / "t"), df.schema).where(F.col("month") == F.lit(day(32)))
    assert rows(back, "date") == [(day(32),)] * 3


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared + "/") and one != two


def scanned(df):
    """The result's rows, and how many rows the scan took from the files."""
    found = df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return found, scan.metrics().apply("numOutputRows").value()


def test_clustered_table_reads_few_files_both_ways(spark, tmp_path):
    """256 places on 128 days in 64 files; a third of the rows are of one place."""
    path = str(tmp_path / "t")
    days = spark.range(256 * 128).select(
        F.concat(F.lit("place "), F.col("id") % 256).alias("place"), F.date_add(F.lit(day(1)), (F.col("id") / 256).cast("int")).alias("date"), F.col("id").alias("n"))
    hot = spark.range(16_000).select(F.lit("hot").alias("place"), F.date_add(F.lit(day(1)), (F.col("id") % 128).cast("int")).alias("date"), F.col("id").alias("n"))
    df = days.unionByName(hot)
    write_clustered(df, path, "place", "date", 64)
    back = spark.read.schema(df.schema).parquet(path)
    assert rows(back) == rows(df)
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) <= 64 and max(sizes) < 4 * sum(sizes) / 64
    whole = df.count()
    for n in (3, 77, 200):
        found, read = scanned(back.where(F.col("place") == f"place {n}"))
        assert len(found) == 128 and read < whole / 3
        found, read = scanned(back.where(F.col("date") == F.lit(day(n % 128 + 1))))
        assert len(found) == 256 + 125 and read < whole / 3


def test_clustered_table_of_few_or_no_rows(spark, tmp_path):
    schema = "place string, date date"
    for i, data in enumerate(([], [(None, None)], [("a", day(1)), (None, day(2)), ("b", None)])):
        df = spark.createDataFrame(data, schema)
        write_clustered(df, str(tmp_path / str(i)), "place", "date", 4)
        assert rows(spark.read.schema(df.schema).parquet(str(tmp_path / str(i)))) == rows(df)
