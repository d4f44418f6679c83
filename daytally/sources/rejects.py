"""Readings beside what could not be read: rejected values and lines with their file and reason.

A row is kept if each of its declared values parses; else it goes to the rejects, once for each value at fault,
with the row's text as it stands in the file. Kept and rejected rows together are all rows of the source.
Lines with too few or too many values (CSV), or that are no JSON, are rejected whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .readers import check_fields, field, find_columns, json_rows, typed

REASONS = {"bigint": "no whole number", "int": "no whole number", "date": "no date"}
#: Column of the raw line where Spark puts what it can't split; no source has a column of that name.
BROKEN = "_broken_line"


@dataclass(frozen=True)
class Parsed:
    """``kept`` has the declared columns; ``rejects`` has file, column, value, reason and the text of the row
    (``column`` and ``value`` are null for a line rejected whole)."""

    kept: DataFrame
    rejects: DataFrame


def _parsed(rows: DataFrame, texts: dict[str, Column], schema: T.StructType, broken: Column, text: Column, file: Column) -> Parsed:
    """``texts`` has the raw text of each declared column; ``broken`` tells a line rejected whole."""
    nothing = F.lit(None).cast("string")

    def fault(column: Column, value: Column, reason: str) -> Column:
        return F.struct(column.alias("column"), value.alias("value"), F.lit(reason).alias("reason"))

    rows = rows.select(
        *[typed(texts[f.name], f.dataType).alias(f.name) for f in schema],
        F.array(*[texts[f.name] for f in schema]).alias("_texts"),
        broken.alias("_broken"), text.alias("_text"), file.alias("_file"))
    faults = [F.when(F.col("_broken"), fault(nothing, nothing, "no such line"))]
    for i, f in enumerate(schema):
        at_fault = ~F.col("_broken") & F.col("_texts")[i].isNotNull() & F.col(f"`{f.name}`").isNull()
        reason = REASONS.get(f.dataType.simpleString(), "not of its type")
        faults.append(F.when(at_fault, fault(F.lit(f.name), F.col("_texts")[i], reason)))
    rows = rows.withColumn("_faults", F.filter(F.array(*faults), lambda x: x.isNotNull()))
    kept = rows.where(F.size("_faults") == 0).select(*[f"`{c}`" for c in schema.names])
    rejects = rows.where(F.size("_faults") > 0).select(
        F.col("_file").alias("file"), F.inline("_faults"), F.col("_text").alias("text"))
    return Parsed(kept, rejects)


def parse_csv(spark: SparkSession, path, schema: T.StructType) -> Parsed:
    """As ``read_csv``, with the rows apart that have values it would make null. The text of a row
    is its values as JSON, by the header's names; of a broken line, the line."""
    # Pruned columns would hide that a line has too few or too many values.
    options = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}
    header = spark.read.options(**options).csv(path).columns
    lines = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BROKEN]])
    rows = spark.read.options(**options).schema(lines).csv(path)
    names = find_columns(header, schema, path)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in header]))
    texts = {name: F.col(f"`{column}`") for name, column in names.items()}
    return _parsed(rows, texts, schema, F.col(BROKEN).isNotNull(), F.coalesce(BROKEN, whole), F.col("_metadata.file_path"))


def parse_json(spark: SparkSession, path, schema: T.StructType) -> Parsed:
    """As ``read_json``, with lines that hold no JSON object, and rows with values it would make null,
    apart. The text of a row is its line."""
    rows = json_rows(spark, path)
    check_fields(rows, schema, path)
    texts = {f.name: field(f.name) for f in schema}
    return _parsed(rows, texts, schema, F.col("_fields").isNull(), F.col("_line"), F.col("_file"))
