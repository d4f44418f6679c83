"""Data-quality reports: one row per check, for the caller to act on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import pair_totals, renamed, union_tables
from ..schemas import BRAZIL_NAME, USA_NAME
from .facts import DETAILED, WORLD_KEYS, brazil_states, counted_rows, with_day


def _distinct(df: DataFrame, side: str, **checks: Column) -> DataFrame:
    """A row for each check: how many different values ``df`` has, in one pass."""
    counted = df.agg(*[F.count_distinct(value).alias(name) for name, value in checks.items()])
    rows = [F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("n")) for name in checks]
    return counted.select(F.lit(side).alias("side"), F.inline(F.array(*rows)))


def _counts(df: DataFrame, country: Column, date: Column, side: str) -> DataFrame:
    return _distinct(df, side, countries=country, dates=date)


def _report(dimension: DataFrame, fact: DataFrame, first_days: int) -> DataFrame:
    def side(name: str) -> Column:
        return F.sum(F.when(F.col("side") == name, F.col("n"))).alias(f"{name}_count")

    missing = F.col("dimension_count") - F.col("fact_count")
    allowed = F.when(F.col("check_name").endswith("dates"), first_days).otherwise(0)
    return (
        dimension.unionByName(fact)
        .groupBy("check_name")
        .agg(side("dimension"), side("fact"))
        .withColumn("passed", missing.between(0, allowed))
    )


def source_report(world: DataFrame, no_deaths: tuple = DETAILED) -> DataFrame:
    """Distinct countries and dates in the world file against those that got an increment.

    The first date never has one, so ``dates`` fails on sound data; ``lake_report`` is the
    check to act on. Only which key-days have a day before matters, for any source: one
    shuffle, without the counts.
    """
    counted = with_day(counted_rows(world, no_deaths, ()))
    increments = pair_totals(counted, WORLD_KEYS, "day", [])
    return _report(
        _counts(world, F.col("country_region"), F.col("date"), "dimension"),
        _counts(increments, F.col("country_region"), F.col("day"), "fact"),
        first_days=0,
    )


def lake_report(
    dim_country: DataFrame,
    dim_time: DataFrame,
    fact_country: DataFrame,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """Distinct countries and dates of the written dimensions against the written fact.

    ``aliases`` maps a fact's country name to the dimension's where the two differ. The first
    date may be missing from the fact, since it has no day before.
    """
    countries = dim_country.agg(F.count_distinct("country_region").alias("n")).select(
        F.lit("dimension").alias("side"), F.lit("countries").alias("check_name"), "n"
    )
    dates = dim_time.agg(F.count_distinct("date_key").alias("n")).select(
        F.lit("dimension").alias("side"), F.lit("dates").alias("check_name"), "n"
    )
    name = renamed(F.col("country_name"), aliases)
    return _report(
        countries.unionByName(dates), _counts(fact_country, name, F.col("date"), "fact"), 1
    )


def whole_report(
    tables: dict[str, DataFrame],
    sources: dict[str, DataFrame] | None = None,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """``lake_report`` over all five tables, and what of each source has arrived.

    ``provinces`` and ``province_dates`` hold the province dimension and the dates against the province
    fact. ``source:<name>`` holds the places of a landed source (countries of the world file, states of the
    others) against those in the facts; a state that the lookup lacks shows here. Each table is read
    once, and of the written ones only the columns of their folders.
    """
    def place(df: DataFrame, country: str) -> Column:
        return F.struct(renamed(F.col(country), aliases), F.col("province_state"))

    country_fact, province_fact = tables["fact_covid_country"], tables["fact_covid_country_province"]
    country = renamed(F.col("country_name"), aliases)
    of = {name: F.when(F.col("country_name") == name, F.col("province_state")) for name in (BRAZIL_NAME, USA_NAME)}
    dates = tables["dim_time"].agg(F.count_distinct("date_key").alias("n"))
    left = [
        _distinct(tables["dim_country"], "dimension", countries=F.col("country_region")),
        dates.select(
            F.lit("dimension").alias("side"),
            F.explode(F.array(F.lit("dates"), F.lit("province_dates"))).alias("check_name"), "n"),
        _distinct(tables["dim_province"], "dimension", provinces=place(tables["dim_province"], "country_region")),
    ]
    of_country = {"countries": country, "dates": F.col("date")}
    of_province = {"provinces": place(province_fact, "country_name"), "province_dates": F.col("date")}
    if sources:
        of_country["source:world"] = country
        of_province |= {"source:brazil": of[BRAZIL_NAME], "source:usa": of[USA_NAME]}
        states = brazil_states(sources["brazil"])
        left += [
            _distinct(sources["world"], "dimension", **{"source:world": F.col("country_region")}),
            _distinct(states, "dimension", **{"source:brazil": F.col("state")}),
            _distinct(sources["usa"], "dimension", **{"source:usa": F.col("state_name")}),
        ]
    right = [_distinct(country_fact, "fact", **of_country), _distinct(province_fact, "fact", **of_province)]
    return _report(union_tables(*left), union_tables(*right), 1)
