"""Increments from a carried state: each key's last reading stands in for all days before.

With the state, the new days of a load are enough to compute their increments: no row of an earlier
day is read. A reading that comes late, for a day that its key's state has passed, can't be placed from the
state alone; ``late_keys`` finds the keys concerned, whose days are to be computed anew from their
readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .delta import daily_delta


def last_readings(df: DataFrame, keys: list[str], date: str, measures: list[str]) -> DataFrame:
    """The state after ``df``: one row per key with its last day and the reading of that day. Rows with a
    null key or date, which never get an increment, have none."""
    known = df.dropna(subset=[*keys, date])
    last = F.max_by(F.struct(date, *measures), date).alias("_last")
    return known.groupBy(*keys).agg(last).select(*keys, "_last.*")


def late_keys(new: DataFrame, state: DataFrame, keys: list[str], date: str) -> DataFrame:
    """The keys of ``new`` that have a row for a day which ``state`` has reached or passed."""
    reached = state.select(*keys, F.col(date).alias("_reached"))
    first = new.groupBy(*keys).agg(F.min(date).alias("_first"))
    return first.join(reached, keys).where(F.col("_first") <= F.col("_reached")).select(*keys)


def carried_delta(
    new: DataFrame, state: DataFrame, keys: list[str], date: str, measures: list[str]
) -> DataFrame:
    """The increments of the rows of ``new``, as ``daily_delta`` would give for them with all earlier rows.

    Both have one row per key and day, and all days of ``new`` are after the state of their key.
    The state's rows take part as the days before; they have none before themselves, so they give no
    row. One shuffle by key of the new rows and a row for each key.
    """
    columns = [*keys, date, *measures]
    return daily_delta(state.select(*columns).unionByName(new.select(*columns)), keys, date, measures, "lag")


def next_state(
    new: DataFrame, state: DataFrame, keys: list[str], date: str, measures: list[str]
) -> DataFrame:
    """The state after a load of ``new``."""
    columns = [*keys, date, *measures]
    return last_readings(state.select(*columns).unionByName(new.select(*columns)), keys, date, measures)
