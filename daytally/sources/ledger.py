"""Landing by file: a ledger of the files of a source, so that only new and changed ones are read.

A source is a folder (or several) that files are added to, replaced in and withdrawn from. The
ledger has a row for each file that counts: path, size, modification time and the number of the
landing that read it. A landing joins it with a listing of the source, which reads no file, and reads
what the ledger lacks. Rows carry their file and landing; those whose file has been replaced or
withdrawn since no longer match the ledger and so no longer count, without any rewriting.

Both are tables of a versioned folder (see ``sinks.versions``): a landing that breaks off leaves all as
it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sinks import Part, commit, read_parts, read_version, run_path

FILES = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("landing", T.IntegerType()),
])
OF_ROW = ["_file", "_landing"]


def listing(spark: SparkSession, *paths: str) -> DataFrame:
    """file, size and modified of all files below ``paths``; nothing of them is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def compared(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each file of either with its ``status``: ``new``, ``changed``, ``same`` or ``withdrawn``."""
    old = ledger.select("file", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"), F.col("landing"))
    here, there = F.col("size").isNotNull(), F.col("old_size").isNotNull()
    same = (F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified"))
    status = F.when(~there, "new").when(~here, "withdrawn").when(same, "same").otherwise("changed")
    return listed.join(old, "file", "full").withColumn("status", status)


def _literal(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


class LandedFiles:
    """The rows of a source, landed by file at ``path``.

    ``read`` turns paths into rows with the columns of ``schema``; it is given only files to be read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, read: Callable[[SparkSession, list[str]], DataFrame]):
        self.spark, self.path, self.read = spark, path.rstrip("/"), read
        self.schema = schema
        self.landed = T.StructType([*schema, T.StructField("_file", T.StringType()), T.StructField("_landing", T.IntegerType())])

    def ledger(self, number: int | None = None) -> DataFrame:
        """The files that count, after the last landing or after landing ``number``."""
        version = read_version(self.spark, self.path, number)
        if version is None:
            return self.spark.createDataFrame([], FILES)
        return read_parts(self.spark, self.path, version.tables["files"], FILES)

    def land(self, *sources: str) -> DataFrame:
        """Read what is new below ``sources``; returns the number of files and bytes by status."""
        base = read_version(self.spark, self.path)
        number = base.number + 1 if base else 1
        run = f"landing{number}-{uuid.uuid4().hex[:8]}"

        def place(table: str) -> str:
            return f"{self.path}/{run_path(run, table)}"

        found = compared(listing(self.spark, *sources), self.ledger(base and base.number))
        found.write.parquet(place("compared"))
        found = self.spark.read.schema(found.schema).parquet(place("compared"))
        unread = F.col("status").isin("new", "changed")
        kept = found.where("status <> 'withdrawn'").withColumn("landing", F.when(unread, number).otherwise(F.col("landing")))
        kept.select(*FILES.names).write.parquet(place("files"))
        # The names of the files to be read; Spark's own list of them is on the driver too.
        names = [r["file"] for r in found.where(unread & (F.col("size") > 0)).select("file").collect()]
        parts, added = {"files": Part(run_path(run, "files"))}, []
        if names:
            rows = self.read(self.spark, [_literal(n) for n in names])
            # Rows name their file as an encoded URI, the listing doesn't.
            named = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("_file")
            rows = rows.select(*self.schema.names, named)
            rows.withColumn("_landing", F.lit(number)).write.parquet(place("rows"))
            parts["rows"], added = Part(run_path(run, "rows")), ["rows"]
        commit(self.spark, self.path, run, parts, base, added)
        return found.groupBy("status").agg(
            F.count("*").alias("files"), F.sum(F.coalesce("size", "old_size")).alias("bytes"))

    def rows(self, number: int | None = None) -> DataFrame:
        """The rows of the files that count, after the last landing or after landing ``number``."""
        version = read_version(self.spark, self.path, number)
        if version is None or "rows" not in version.tables:
            return self.spark.createDataFrame([], self.schema)
        rows = read_parts(self.spark, self.path, version.tables["rows"], self.landed)
        counts = self.ledger(version.number).select(F.col("file").alias("_file"), F.col("landing").alias("_landing"))
        return rows.join(counts, OF_ROW, "left_semi").select(*self.schema.names)
