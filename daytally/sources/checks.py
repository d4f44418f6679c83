"""Checks of a source before anything is built from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..operators import Form


def _repeated(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    per_day = df.dropna(subset=[*keys, date]).groupBy(*keys, date).agg(F.count("*").alias("n"))
    return per_day.where(F.col("n") > 1)


def repeated_days(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """One row: on how many key-days (``repeated_days``) there is more than one row."""
    return _repeated(df, keys, date).agg(F.count("*").alias("repeated_days"))


def choose_form(df: DataFrame, keys: list[str], date: str, path: str) -> Form:
    """The cheapest increment form that is right for ``df`` (see ``operators.distinct_delta``).

    Writes the keys that have repeated days to ``path``: none allow the lag form for all, else
    those keys are split off and joined, whatever their number.
    """
    _repeated(df, keys, date).select(*keys).distinct().write.mode("overwrite").parquet(path)
    found = df.sparkSession.read.schema(df.select(*keys).schema).parquet(path)
    return "lag" if found.isEmpty() else found


def _counts(not_null: list[str]) -> list[Column]:
    return [F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in not_null]]


def _checks(required: list[str], not_null: list[str], columns: list[str], found: Callable[[str], Column]) -> Column:
    """The rows of a report as an array; ``found`` gives a count by its name."""
    present = {c.lower() for c in columns}

    def row(name, found, passed):
        return F.struct(
            F.lit(name).alias("check_name"),
            found.cast("bigint").alias("found"),
            passed.alias("passed"),
        )

    rows = [row("rows", found("rows"), found("rows") > 0)]
    for c in required:
        there = F.lit(int(c.lower() in present))
        rows.append(row(f"column:{c}", there, there == 1))
    for c in not_null:
        n = found(f"nulls:{c}")
        rows.append(row(f"nulls:{c}", n, n == 0))
    return F.array(*rows)


def _checkable(df: DataFrame, not_null: list[str]) -> list[str]:
    present = {c.lower() for c in df.columns}
    return [c for c in not_null if c.lower() in present]


def input_check(df: DataFrame, required: list[str], not_null: list[str]) -> DataFrame:
    """One row per check: ``check_name``, ``found`` and whether it ``passed``.

    ``column:<c>`` finds 1 when a required column is there, ``rows`` must be above 0, and
    ``nulls:<c>`` must be 0. One pass over the columns concerned.
    """
    checkable = _checkable(df, not_null)
    counts = df.agg(*_counts(checkable))
    return counts.select(F.inline(_checks(required, checkable, df.columns, lambda name: F.col(f"`{name}`"))))


def watch(df: DataFrame, required: list[str], not_null: list[str]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df``, and a function for its ``input_check`` without a pass of its own.

    The counts are taken while the first action reads ``df``, which must be one that reads all of its
    rows, such as a write; only then can the function be called. Counts of a task that is
    tried again count once, as long as nothing is shuffled after ``df``.
    """
    checkable, seen = _checkable(df, not_null), Observation()
    names = ["rows", *(f"nulls:{c}" for c in checkable)]
    watched, spark, columns = df.observe(seen, *_counts(checkable)), df.sparkSession, df.columns

    def report() -> DataFrame:
        # Nothing is counted where Spark finds that there is no row.
        found = {name: (seen.get or {}).get(name) or 0 for name in names}
        rows = _checks(required, checkable, columns, lambda name: F.lit(found[name]))
        return spark.range(1).select(F.inline(rows))

    return watched, report
