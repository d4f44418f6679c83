"""Small table-level helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_tables(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order, so that two runs show the same rows."""
    return df.orderBy(*order_by).limit(n)


def renamed(name: Column, aliases: dict[str, str] | None) -> Column:
    """``name`` with the spellings in ``aliases`` replaced."""
    out = name
    for old, new in (aliases or {}).items():
        out = F.when(name == old, new).otherwise(out)
    return out
