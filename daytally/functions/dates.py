"""Date text in month/day/year order, and back. Built-in expressions only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def date_parts(text: Column) -> dict[str, Column]:
    """Zero-padded ``month``, ``day`` and ``year`` text of a ``M/d/yyyy`` column.

    A part that is missing becomes null instead of failing the job.
    """
    parts = F.split(text, "/")
    widths = {"month": 2, "day": 2, "year": 4}
    return {
        name: F.lpad(F.get(parts, F.lit(i)), width, "0")
        for i, (name, width) in enumerate(widths.items())
    }


def parse_mdy(text: Column) -> Column:
    """``M/d/yyyy`` text, padded or not, as a date; null when it is not a date."""
    return F.try_to_date(text, "M/d/yyyy")


def date_text(date: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(date, pattern)


def to_mdy(day: dt.date) -> str:
    """The unpadded text the world file uses for a day: a predicate on it reaches the scan."""
    return f"{day.month}/{day.day}/{day.year}"
