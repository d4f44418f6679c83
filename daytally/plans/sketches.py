"""Distinct counts over a lake from sketches alone.

For each part of a table and each day there is a HyperLogLog sketch of the columns counted, a few KB
at most. They are made once for each part, from its folder columns, and merged on request: a count over any
version, or over some days of it, reads no fact. With ``LG_K`` = 12 an estimate has a standard error
of 1.6 %; small counts are nearly exact.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators import renamed, union_tables
from ..schemas import ALIASES, TABLES
from ..sinks import Part, Version, commit, read_parts, read_version, run_path

LG_K = 12
NAME = "sketches"
SCHEMA = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("column_name", T.StringType()), T.StructField("sketch", T.BinaryType()), T.StructField("rows", T.LongType()),
])


def _counted(table: str) -> tuple[str | None, dict[str, Column]]:
    """The date column of a table, and what is counted in it."""
    if table == "dim_time":
        return "date_key", {"dates": F.col("date_key").cast("string")}
    country = renamed(F.col("country_region" if table.startswith("dim_") else "country_name"), ALIASES)
    counted = {"countries": country}
    if "province" in table:
        counted["provinces"] = F.concat_ws("\n", country, F.col("province_state"))
    if table.startswith("fact_"):
        counted["dates"] = F.col("date").cast("string")
    return ("date" if table.startswith("fact_") else None), counted


def part_sketches(rows: DataFrame, part: str, table: str) -> DataFrame:
    """The sketches of one part, by day; one shuffle of a sketch for each task, day and column."""
    date, counted = _counted(table)
    day = F.col(date) if date else F.lit(None).cast("date")
    sketches = [F.hll_sketch_agg(c, LG_K).alias(name) for name, c in counted.items()]
    by_day = rows.groupBy(day.alias("day")).agg(F.count("*").alias("rows"), *sketches)
    each = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("sketch")) for name in counted])
    return by_day.select(
        F.lit(part).alias("part"), F.lit(table).alias("table_name"), "day", F.inline(each), "rows").select(*SCHEMA.names)


def sketch_lake(spark: SparkSession, lake: str) -> list[str]:
    """Make the sketches that the latest version lacks, as a version of their own; returns their parts."""
    lake = lake.rstrip("/")
    base = read_version(spark, lake)
    known = set()
    if NAME in base.tables:
        known = {r["part"] for r in _stored(spark, lake, base).select("part").distinct().collect()}
    new = [(table, part) for table in TABLES for part in base.tables[table] if part.path not in known]
    if new:
        run = f"sketched-{uuid.uuid4().hex[:8]}"
        # A part is sketched whole, whatever days of it count now.
        whole = [part_sketches(read_parts(spark, lake, [Part(p.path, month=p.month)], TABLES[t]), p.path, t) for t, p in new]
        union_tables(*whole).write.parquet(f"{lake}/{run_path(run, NAME)}")
        commit(spark, lake, run, {NAME: Part(run_path(run, NAME))}, base, [NAME])
    return [part.path for _, part in new]


def _stored(spark: SparkSession, lake: str, version: Version) -> DataFrame:
    return read_parts(spark, lake, version.tables[NAME], SCHEMA)


def sketched_counts(
    spark: SparkSession, lake: str, version: int | None = None, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """table_name, column_name and about how many different values: of a version, by default the latest, and of
    the days from ``since`` to ``until`` (tables without days count whole). Reads sketches only."""
    lake = lake.rstrip("/")
    found = read_version(spark, lake, version)
    day, counts = F.col("day"), F.lit(False)
    for table in TABLES:
        for part in found.tables[table]:
            own = F.col("part") == part.path
            if part.until is not None:
                own = own & ((day < F.lit(part.until)) | (day.isNull() & F.lit(part.since is None)))
            if part.since is not None:
                own = own & (day >= F.lit(part.since))
            counts = counts | own
    rows = _stored(spark, lake, found).where(counts)
    if since is not None:
        rows = rows.where(day.isNull() | (day >= F.lit(since)))
    if until is not None:
        rows = rows.where(day.isNull() | (day <= F.lit(until)))
    merged = rows.groupBy("table_name", "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("table_name", "column_name", F.hll_sketch_estimate("sketch").alias("estimate"))
