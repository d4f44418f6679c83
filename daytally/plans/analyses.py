"""Analyses over the fact tables.

They expect one row per country and day: build the country fact with ``places="each"`` and
the detailed countries left out of the world part (``no_confirmed``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators import renamed
from ..schemas import ALIASES


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top.cast("double") / bottom.cast("double"))


def compare_countries(
    fact_country: DataFrame,
    dim_country: DataFrame,
    day: dt.date | None = None,
    aliases: dict[str, str] | None = ALIASES,
) -> DataFrame:
    """Counts, counts per 100,000 people, and rank by confirmed cases among the day's countries.

    ``day=None`` compares on every day. Ranking is per day, so no task holds more than one
    day's countries. A country without a dimension row keeps its counts, without rates. Rows
    that are one country after ``aliases`` (a lake built by default has several for the detailed
    ones) are one row, with the largest of each count.
    """
    facts = fact_country if day is None else fact_country.where(F.col("date") == F.lit(day))
    people = dim_country.groupBy("country_region").agg(F.sum("population_count").alias("people"))
    rank = F.rank().over(
        Window.partitionBy("date").orderBy(
            F.col("sum_confirmed_cases").desc_nulls_last(), "country_name"
        )
    )
    counts = ["sum_confirmed_cases", "sum_death_cases"]
    return (
        facts.withColumn("country_region", renamed(F.col("country_name"), aliases))
        .groupBy("date", "country_region")
        .agg(*[F.max(c).alias(c) for c in ("country_name", *counts)])
        .join(people, "country_region", "left")
        .select(
            "date",
            "country_name",
            "sum_confirmed_cases",
            "sum_death_cases",
            _ratio(F.col("sum_confirmed_cases") * 100000, F.col("people"))
            .alias("confirmed_per_100k"),
            _ratio(F.col("sum_death_cases") * 100000, F.col("people")).alias("deaths_per_100k"),
            rank.alias("confirmed_rank"),
        )
    )


def _first_days(fact_country: DataFrame) -> DataFrame:
    return (
        fact_country.where(F.col("sum_confirmed_cases") > 0)
        .groupBy("country_name")
        .agg(F.min("date").alias("first_date"))
    )


def spread(fact_country: DataFrame) -> DataFrame:
    """Per country and day: the first day with confirmed cases and the days since.

    One pass: a window partition holds the days of one country. Countries without a confirmed
    case, and rows without a country, have no first day and are left out.
    """
    reached = F.when(F.col("sum_confirmed_cases") > 0, F.col("date"))
    first = F.min(reached).over(Window.partitionBy("country_name"))
    return (
        fact_country.where(F.col("country_name").isNotNull())
        .withColumn("first_date", first)
        .where(F.col("first_date").isNotNull())
        .select(
            "country_name",
            "date",
            "first_date",
            F.date_diff("date", "first_date").alias("days_since_first"),
            "sum_confirmed_cases",
        )
    )


def countries_reached(fact_country: DataFrame) -> DataFrame:
    """Per day on which the spread reached a new country: how many, and how many so far.

    The running sum is in one partition, of at most one row per calendar day.
    """
    per_day = _first_days(fact_country).groupBy("first_date").agg(F.count("*").alias("reached"))
    so_far = Window.orderBy("first_date").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(
        F.col("first_date").alias("date"),
        "reached",
        F.sum("reached").over(so_far).alias("reached_so_far"),
    )


def mortality_rate(fact: DataFrame) -> DataFrame:
    """Deaths per confirmed case so far; null while there are no confirmed cases."""
    rate = _ratio(F.col("sum_death_cases"), F.col("sum_confirmed_cases"))
    return fact.select(*_place(fact), "date", rate.alias("mortality_rate"))


def percent_increase(fact: DataFrame) -> DataFrame:
    """The day's increment in percent of the count the day before; null from a count of 0."""

    def percent(new: str, total: str) -> Column:
        return _ratio(F.col(new) * 100, F.col(total) - F.col(new))

    return fact.select(
        *_place(fact),
        "date",
        percent("confirmed_cases", "sum_confirmed_cases").alias("pct_confirmed"),
        percent("death_cases", "sum_death_cases").alias("pct_deaths"),
    )


def _place(fact: DataFrame) -> list[str]:
    return [c for c in ("country_name", "province_state") if c in fact.columns]


def trace(
    fact: DataFrame,
    country: str | None = None,
    province: str | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """A place's history in order of days. On a written table every filter prunes folders."""
    rows = fact
    if country is not None:
        rows = rows.where(F.col("country_name") == country)
    if province is not None:
        rows = rows.where(F.col("province_state") == province)
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(until))
    return rows.orderBy(*_place(fact), "date")


def waves(fact_country: DataFrame, least: int = 2) -> DataFrame:
    """Runs of at least ``least`` days in a row on which a country's increment was above that of the day
    before: first and last day, days, cases in all and the largest increment.

    A day without row ends a run, as does a null increment. One shuffle by country; a window partition
    holds the days of one country.
    """
    by_day = Window.partitionBy("country_name").orderBy("date")
    known = fact_country.where(F.col("country_name").isNotNull() & F.col("confirmed_cases").isNotNull())
    rising = (F.lag("confirmed_cases").over(by_day) < F.col("confirmed_cases")) & (
        F.lag("date").over(by_day) == F.date_sub("date", 1))
    # Within a run, a day and its number among the rising days grow alike.
    island = F.date_sub("date", F.row_number().over(by_day))
    runs = known.withColumn("rising", F.coalesce(rising, F.lit(False))).where("rising").withColumn("island", island)
    return (
        runs.groupBy("country_name", "island")
        .agg(
            F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("days"),
            F.sum("confirmed_cases").alias("cases"), F.max("confirmed_cases").alias("peak"))
        .where(F.col("days") >= least)
        .drop("island")
    )


def doubling_time(fact_country: DataFrame, days: int = 7) -> DataFrame:
    """Per country and day: in how many days the confirmed cases double at the growth of the last ``days``
    days, by regression of their logarithm on the day.

    Null where fewer than two of those days have cases, or cases don't grow.
    """
    number = F.unix_date("date")
    window = Window.partitionBy("country_name").orderBy(number).rangeBetween(-(days - 1), 0)
    log = F.when(F.col("sum_confirmed_cases") > 0, F.log("sum_confirmed_cases"))
    rows = fact_country.where(F.col("country_name").isNotNull()).withColumn("_log", log).withColumn("_day", F.when(log.isNotNull(), number))
    slope = F.regr_slope("_log", "_day").over(window)
    return rows.select(
        "country_name", "date", "sum_confirmed_cases",
        F.when(slope > 1e-12, F.log(F.lit(2.0)) / slope).alias("doubling_days"))
