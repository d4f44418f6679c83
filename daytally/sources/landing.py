"""Landing: read a changing source once, keep a typed copy, and build from the copy."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .checks import watch


def land(raw: DataFrame, path: str) -> DataFrame:
    """Write ``raw`` without repeated rows to ``path`` and return the written copy.

    Removing repeated rows needs every column, so it is done once here; whatever reads the
    copy afterwards touches only the columns it uses. Copies collapse before the shuffle, and
    the rows are then spread by their whole content.
    """
    raw.dropDuplicates().write.mode("overwrite").parquet(path)
    return load_snapshot(raw.sparkSession, path, raw.schema)


def land_checked(
    raw: DataFrame, path: str, required: list[str], not_null: list[str]
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """As ``land``, with a function for the ``input_check`` of the copy, counted while it was written."""
    rows, report = watch(raw.dropDuplicates(), required, not_null)
    rows.write.mode("overwrite").parquet(path)
    return load_snapshot(raw.sparkSession, path, raw.schema), report


def load_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def land_bucketed(
    raw: DataFrame, path: str, keys: list[str], date: str, buckets: int
) -> DataFrame:
    """As ``land``, with the rows of a key in one bucket and in order of days, so that windows and groupings
    by ``keys`` on the copy need no shuffle.

    Rows are shuffled once, by key, both to drop repeated rows and to fill the buckets, each by one task: take
    so many that a bucket fits a task. Spark knows buckets from its catalog only, so the copy is a table
    of this session's catalog under a name of its own, with its files at ``path``; another session lists them
    again by landing.
    """
    spark = raw.sparkSession
    name = f"landed_{uuid.uuid4().hex}"
    rows = raw.repartition(buckets, *keys).dropDuplicates()
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, date).option("path", path).saveAsTable(name)
    return spark.table(name)
