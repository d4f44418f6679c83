"""All levels at once: sums by country, province and month with every subtotal, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LEVELS = ["country_name", "province_state", "month"]


def fact_levels(fact_province: DataFrame) -> DataFrame:
    """Increments of the province fact summed for each combination of ``LEVELS``: by all three, by any two,
    by one, and in all. ``level`` tells them apart: a bit is set for each column that is summed over
    (4 country, 2 province, 1 month), so that a null in such a column is no missing name.

    One shuffle: rows are grown to the eight combinations and summed before it.
    """
    rows = fact_province.withColumn("month", F.trunc("date", "month"))
    sums = [F.sum(c).alias(c) for c in ("confirmed_cases", "death_cases")]
    return rows.cube(*LEVELS).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("days"), *sums)
