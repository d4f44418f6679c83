"""What the operators of this subpackage share: stored tables, column names, whole-row helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daytally.sinks import scratch_dir

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"


class Store:
    """Intermediate tables in one fresh folder that every executor reaches.

    A written table cuts the lineage: if an executor is lost later, its rows are read again
    instead of being computed again. ``drop`` deletes a table that no later step reads; what
    is left goes when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self._fs, root = self._hadoop(self.root)
        self._fs.mkdirs(root)
        self._fs.deleteOnExit(root)

    def _hadoop(self, path: str):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            fs, place = self._hadoop(f"{self.root}/{name}")
            fs.delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null. Each word with the space round it becomes one
    character, and those are counted."""
    marks = F.regexp_replace(text, rf"[{SPACE_CLASS}]*{WORD}[{SPACE_CLASS}]*", "x")
    return F.when(text.rlike(rf"[^{SPACE_CLASS}]"), F.length(marks)).otherwise(0).cast("long")
