"""Country, province and time dimensions.

Source frames are free of repeated rows (``sources.land`` sees to that).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import date_parts, parse_mdy
from ..operators import join_lookup, union_tables
from ..schemas import BRAZIL_NAME, DEATHS, STATE_LEVEL, USA_SHORT
from .facts import with_day

# Fixed value: the day whose population figures fill the dimensions.
POPULATION_DAY = dt.date(2020, 5, 19)


def _population_slice(world: DataFrame, as_of: dt.date) -> DataFrame:
    # By the date itself, since its text may be padded; a landed copy has it as a column.
    return with_day(world).where((F.col("case_type") == DEATHS) & (F.col("day") == F.lit(as_of)))


def dim_country(world: DataFrame, as_of: dt.date = POPULATION_DAY) -> DataFrame:
    """Population by country and its two codes; a country has a row per pair of codes."""
    return (
        _population_slice(world, as_of)
        .groupBy("country_region", "iso2", "iso3")
        .agg(F.sum("population_count").alias("population_count"))
    )


def dim_province_usa(
    world: DataFrame,
    as_of: dt.date = POPULATION_DAY,
    country: str = USA_SHORT,
    population: str = "max",
) -> DataFrame:
    """Population by state from the world file.

    ``population="max"`` keeps the largest place of a state, ``"sum"`` adds its places up.
    """
    total = {"max": F.max, "sum": F.sum}[population]
    return (
        _population_slice(world, as_of)
        .where(F.col("country_region") == country)
        .groupBy("country_region", "province_state")
        .agg(total("population_count").alias("population_count"))
    )


def dim_province_brazil(
    brazil: DataFrame, provinces: DataFrame, as_of: dt.date = POPULATION_DAY
) -> DataFrame:
    """Population by state, named through the lookup (keys compared as they are).

    Summed by state before the join, so only one row per state meets the lookup.
    """
    states = (
        brazil.where((F.col("place_type") == STATE_LEVEL) & (F.col("date") == F.lit(as_of)))
        .groupBy("state")
        .agg(F.sum("estimated_population_2019").alias("people"))
    )
    return (
        join_lookup(states, provinces, "state")
        .groupBy("province_state")
        .agg(F.sum("people").alias("population_count"))
        .select(F.lit(BRAZIL_NAME).alias("country_region"), "province_state", "population_count")
    )


def dim_province(
    world: DataFrame,
    brazil: DataFrame,
    provinces: DataFrame,
    as_of: dt.date = POPULATION_DAY,
    usa_country: str = USA_SHORT,
    usa_population: str = "max",
) -> DataFrame:
    return union_tables(
        dim_province_usa(world, as_of, usa_country, usa_population),
        dim_province_brazil(brazil, provinces, as_of),
    )


def dim_time(world: DataFrame, country: str | None = BRAZIL_NAME) -> DataFrame:
    """One row per date text, split up; ``country=None`` takes the dates of all countries.

    ``date_key`` is the date itself, to join with a fact's ``date``.
    """
    rows = world if country is None else world.where(F.col("country_region") == country)
    parts = date_parts(F.col("date"))
    return (
        rows.select("date")
        .distinct()
        .withColumn("date_key", parse_mdy(F.col("date")))
        .select(
            "date",
            parts["year"].alias("year"),
            F.weekofyear("date_key").alias("week"),
            parts["month"].alias("month"),
            parts["day"].alias("day"),
            F.dayofweek("date_key").alias("week_day"),
            "date_key",
        )
    )
