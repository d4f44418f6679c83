"""Partitioned Parquet tables: write, load again without doubling, read with pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    mode: str = "overwrite",
    tasks: int | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Write ``df`` under ``path`` in folders by ``partition_by``.

    Modes: ``overwrite`` replaces the table; ``append`` adds to it (running it twice doubles
    the rows); ``dynamic`` replaces just the folders ``df`` has rows for, so a repeated load
    leaves one copy and other folders stay.

    Rows are first brought together by folder, which keeps the number of files near the number
    of folders. By default the rebalance hint leaves the tasks to adaptive execution, which
    goes by size: a folder far larger than the others is split over several tasks and small ones
    share a task. Where folders are many and tiny (a fact with a folder per place and day), one
    task would then open all the files; ``tasks`` deals the folders out to that many.
    """
    if mode not in ("overwrite", "append", "dynamic"):
        raise ValueError(f"mode must be 'overwrite', 'append' or 'dynamic', not {mode!r}")
    placed = df.repartition(tasks, *partition_by) if tasks else df.hint("rebalance", *partition_by)
    writer = (
        placed.write.mode("overwrite" if mode == "dynamic" else mode)
        .option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    writer.partitionBy(*partition_by).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_table(spark: SparkSession, path: str) -> None:
    fs, place = hadoop(spark, path)
    fs.delete(place, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written table with its declared types.

    Folder names carry no type; without a schema Spark would guess one and turn month ``05``
    into the number 5. Filters on folder columns prune folders, others reach the row groups.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def with_month(df: DataFrame, date: str = "date") -> DataFrame:
    """``df`` with ``month``, the first day of the date's month: a folder column for tables too
    fine for a folder per day."""
    return df.withColumn("month", F.trunc(date, "month"))
