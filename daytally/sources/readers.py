"""Readers for the raw files. A path may be any file, folder or glob Spark can reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Rows that are looked at first for the names of fields.
FIRST_ROWS = 1000


def typed(text: Column, dtype: T.DataType) -> Column:
    """A text as a value of its declared type; null where it is none."""
    if isinstance(dtype, T.LongType):
        # Counts are sometimes written as "12.0"; both spellings are the same number. A count with
        # a fraction is none: it becomes null, which the input check counts.
        exact = text.try_cast("decimal(38,9)")
        whole = F.when(exact == F.floor(exact), exact).try_cast("bigint")
        return F.coalesce(text.try_cast("bigint"), whole)
    return text.try_cast(dtype)


def find_columns(columns: list[str], schema: T.StructType, path) -> dict[str, str]:
    """The column for each declared name, whatever its case."""
    present = {c.lower(): c for c in columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {columns}")
    return {f.name: present[f.name.lower()] for f in schema}


def _declared(raw: DataFrame, schema: T.StructType, path) -> DataFrame:
    names = find_columns(raw.columns, schema, path)
    return raw.select(*[typed(F.col(f"`{names[f.name]}`"), f.dataType).alias(f.name) for f in schema])


def read_csv(
    spark: SparkSession, path, schema: T.StructType, spread: int | None = None
) -> DataFrame:
    """A comma-separated file with a header, plain or gzipped (told by the suffix).

    Columns are found by header name whatever their order or case; only the declared ones are
    parsed. A value that does not fit its type becomes null, which ``input_check`` counts.
    Spark cannot split a gzip file, so one file is one task; ``spread`` deals its rows out to
    that many tasks, worth it when heavy work follows before the next shuffle.
    """
    # Unenforced, a file of a folder whose header differs from the first one's is an error
    # instead of being read in the wrong order.
    raw = spark.read.options(header=True, enforceSchema=False).csv(path)
    table = _declared(raw, schema, path)
    return table.repartition(spread) if spread else table


def json_rows(spark: SparkSession, path) -> DataFrame:
    """Each JSON object of ``path`` as ``_fields``, a map of its names to texts, beside its ``_line`` and
    ``_file``. A line may hold one object or an array of them; any other is one row without fields."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    line = F.ltrim("value")
    objects = F.when(line.startswith("["), F.from_json("value", "array<map<string,string>>")).when(
        line.startswith("{"), F.array(F.from_json("value", "map<string,string>")))
    one = F.explode_outer(objects).alias("_fields")
    return lines.select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"), one)


def field(name: str) -> Column:
    """The text of a field of ``json_rows``, by its name in any case."""
    named = F.filter(F.map_entries("_fields"), lambda e: F.lower(e["key"]) == name.lower())
    return F.get(named, F.lit(0))["value"]


def check_fields(rows: DataFrame, schema: T.StructType, path) -> None:
    """Raise an error if ``json_rows`` has rows, but a field of ``schema`` in none. The first rows mostly
    have all; only otherwise are the others looked at."""
    names = F.transform(F.map_keys("_fields"), lambda k: F.lower(k))
    has = [F.max(F.array_contains(names, f.name.lower())).alias(f.name) for f in schema]
    for some in (rows.limit(FIRST_ROWS), rows):
        found = some.agg(F.count("*").alias("_n"), *has).first()
        missing = [f.name for f in schema if not found[f.name]]
        if not found["_n"] or not missing:
            return
    raise ValueError(f"{path} lacks the columns {missing}")


def read_json(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines. Fields are found by name whatever their case, as in CSV, and their texts are typed as
    for CSV; each line is parsed once. A field that no row has is an error; a source without any row has
    none and is empty."""
    rows = json_rows(spark, path)
    check_fields(rows, schema, path)
    return rows.select(*[typed(field(f.name), f.dataType).alias(f.name) for f in schema])


def read_inferred(spark: SparkSession, path, format: str = "csv", **options) -> DataFrame:
    """Let Spark work out the types, at the price of one more pass over the file."""
    defaults = {"header": True, "inferSchema": True} if format == "csv" else {}
    return spark.read.options(**{**defaults, **options}).format(format).load(path)
