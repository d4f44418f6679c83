"""Daily facts by country and by province.

Source frames are free of repeated rows. ``how`` is the increment form (see
``operators.distinct_delta``): ``"join"`` is right for any source, ``sources.choose_form`` finds
the cheapest one that is right for a given source. Tables made of several sources take a form
for each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parse_mdy
from ..operators import Form, distinct_delta, join_lookup, pair_totals, union_tables
from ..schemas import (
    BRAZIL_NAME, CONFIRMED, DEATHS, FACT_COUNTRY, FACT_PROVINCE, MEASURES, STATE_LEVEL,
    USA_NAME, USA_SHORT,
)

# Fixed value: countries whose deaths come from their own, more detailed source.
DETAILED = (BRAZIL_NAME, USA_SHORT)

Forms = Mapping[str, Form]
ANY_SOURCE: Forms = {"world": "join", "brazil": "join", "usa": "join"}
ONE_READING: Forms = {"world": "lag", "brazil": "lag", "usa": "lag"}


def one_reading_forms(increments: str = "lag") -> Forms:
    """The form for sources with one reading a place and day: ``"lag"``, or ``"spread"`` to keep first days and
    days after gaps, or ``"risen"`` to have no increment below zero."""
    if increments not in ("lag", "spread", "risen"):
        raise ValueError(f"increments must be 'lag', 'spread' or 'risen', not {increments!r}")
    return dict.fromkeys(ONE_READING, increments)

BRAZIL_KEYS = ["state"]
BRAZIL_COUNTS = ["last_available_confirmed", "last_available_deaths"]
USA_KEYS = ["state_name", "state_fips"]
USA_COUNTS = ["cases", "deaths"]
WORLD_KEYS = ["case_type", "country_region", "combined_key"]


def _measure_sources(confirmed: str, deaths: str) -> list[str]:
    """The columns that hold each of ``MEASURES`` after an increment step."""
    return [f"{confirmed}_delta", f"{deaths}_delta", confirmed, deaths]


def _measures(confirmed: str, deaths: str) -> list[Column]:
    return [F.col(c).alias(m) for c, m in zip(_measure_sources(confirmed, deaths), MEASURES)]


def _by_day(totals: DataFrame, confirmed: str, deaths: str, country: str) -> DataFrame:
    sources = zip(_measure_sources(confirmed, deaths), MEASURES)
    sums = totals.groupBy("date").agg(*[F.sum(c).alias(m) for c, m in sources])
    return sums.select(F.lit(country).alias("country_name"), "date", *MEASURES)


def brazil_states(brazil: DataFrame) -> DataFrame:
    return brazil.where(F.col("place_type") == STATE_LEVEL)


def brazil_province(brazil: DataFrame, provinces: DataFrame, how: Form = "join") -> DataFrame:
    """By state and day; the lookup's keys may carry blanks."""
    days = distinct_delta(brazil_states(brazil), BRAZIL_KEYS, "date", BRAZIL_COUNTS, how)
    return (
        join_lookup(days, provinces, "state", trimmed=True)
        .select(F.lit(BRAZIL_NAME).alias("country_name"), "province_state", "date",
                *_measures(*BRAZIL_COUNTS))
        .distinct()
    )


def brazil_country(brazil: DataFrame, how: Form = "join") -> DataFrame:
    totals = pair_totals(brazil_states(brazil), BRAZIL_KEYS, "date", BRAZIL_COUNTS, how)
    return _by_day(totals, *BRAZIL_COUNTS, country=BRAZIL_NAME)


def usa_province(usa: DataFrame, how: Form = "join") -> DataFrame:
    """By state and day. Two states of one name and different codes stay apart until the end."""
    return (
        distinct_delta(usa, USA_KEYS, "date", USA_COUNTS, how)
        .select(F.lit(USA_NAME).alias("country_name"),
                F.col("state_name").alias("province_state"), "date", *_measures(*USA_COUNTS))
        .distinct()
    )


def usa_country(usa: DataFrame, how: Form = "join") -> DataFrame:
    totals = pair_totals(usa, USA_KEYS, "date", USA_COUNTS, how)
    return _by_day(totals, *USA_COUNTS, country=USA_NAME)


def with_day(world: DataFrame) -> DataFrame:
    """The world file with ``day``, its date text as a date, unless it was landed with it."""
    if "day" in world.columns:
        return world
    return world.withColumn("day", parse_mdy(F.col("date")))


def world_days(world: DataFrame) -> DataFrame:
    """The columns that increments of the world file need."""
    return with_day(world).select(*WORLD_KEYS, "day", "cases")


def _largest(df: DataFrame, keys: list[str], date: str, counts: list[str]) -> DataFrame:
    return df.groupBy(*keys, date).agg(*[F.max(c).alias(c) for c in counts])


def one_reading(world: DataFrame, brazil: DataFrame, usa: DataFrame) -> dict[str, DataFrame]:
    """The three sources with one row per place and day, as ``ONE_READING`` needs: of a day that was
    revised, the largest of each count."""
    return {
        "world": _largest(world_days(world), WORLD_KEYS, "day", ["cases"]),
        "brazil": _largest(
            brazil_states(brazil), [*BRAZIL_KEYS, "place_type"], "date", BRAZIL_COUNTS
        ),
        "usa": _largest(usa, USA_KEYS, "date", USA_COUNTS),
    }


def counted_rows(world: DataFrame, no_deaths: tuple, no_confirmed: tuple) -> DataFrame:
    """Confirmed and death rows, less those of the countries named for either type."""
    kind, country = F.col("case_type"), F.col("country_region")
    confirmed, deaths = kind == CONFIRMED, kind == DEATHS
    if no_confirmed:
        confirmed = confirmed & ~country.isin(*no_confirmed)
    if no_deaths:
        deaths = deaths & ~country.isin(*no_deaths)
    return world.where(confirmed | deaths)


def _split_by_type() -> list[Column]:
    """A column per measure, null in the rows of the other case type."""
    def only(kind: str, value: str) -> Column:
        return F.when(F.col("case_type") == kind, F.col(value))

    columns = [only(CONFIRMED, "cases_delta"), only(DEATHS, "cases_delta"),
               only(CONFIRMED, "cases"), only(DEATHS, "cases")]
    return [c.alias(m) for c, m in zip(columns, MEASURES)]


def _world_rows(world: DataFrame, no_deaths: tuple, no_confirmed: tuple, how: Form) -> DataFrame:
    """Distinct (country, day, type, increment, count): places of a country that agree are one.

    Both case types go through one pass, the type being part of the key.
    """
    days = world_days(counted_rows(world, no_deaths, no_confirmed))
    return (
        distinct_delta(days, WORLD_KEYS, "day", ["cases"], how)
        .select(F.col("country_region").alias("country_name"), F.col("day").alias("date"),
                "case_type", "cases_delta", "cases")
        .distinct()
    )


def world_confirmed(world: DataFrame, exclude: tuple = (), how: Form = "join") -> DataFrame:
    only = world.where(F.col("case_type") == CONFIRMED)
    rows = _world_rows(only, (), exclude, how)
    return rows.select("country_name", "date", *_split_by_type())


def world_deaths(world: DataFrame, exclude: tuple = DETAILED, how: Form = "join") -> DataFrame:
    only = world.where(F.col("case_type") == DEATHS)
    rows = _world_rows(only, exclude, (), how)
    return rows.select("country_name", "date", *_split_by_type())


def world_country(
    world: DataFrame,
    no_deaths: tuple = DETAILED,
    no_confirmed: tuple = (),
    places: str = "distinct",
    how: Form = "join",
) -> DataFrame:
    """Confirmed cases and deaths by country and day.

    ``places="distinct"`` counts places of a country with the same increment and the same
    count on a day once, as existing tables do. ``places="each"`` counts every place.
    """
    if places == "distinct":
        rows = _world_rows(world, no_deaths, no_confirmed, how)
    elif places == "each":
        days = world_days(counted_rows(world, no_deaths, no_confirmed))
        rows = pair_totals(days, WORLD_KEYS, "day", ["cases"], how).select(
            F.col("country_region").alias("country_name"), F.col("day").alias("date"),
            "case_type", "cases_delta", "cases",
        )
    else:
        raise ValueError(f"places must be 'distinct' or 'each', not {places!r}")
    split = rows.select("country_name", "date", *_split_by_type())
    return split.groupBy("country_name", "date").agg(*[F.sum(m).alias(m) for m in MEASURES])


def country_fact(
    world: DataFrame, brazil: DataFrame, usa: DataFrame, forms: Forms = ANY_SOURCE, **world_options
) -> DataFrame:
    """All three sources in one table. As in existing tables, a detailed country also has
    its confirmed cases from the world file; pass ``no_confirmed`` to leave those out."""
    return union_tables(
        brazil_country(brazil, forms["brazil"]),
        usa_country(usa, forms["usa"]),
        world_country(world, how=forms["world"], **world_options),
    ).select(*FACT_COUNTRY.names)


def province_fact(
    brazil: DataFrame, provinces: DataFrame, usa: DataFrame, forms: Forms = ANY_SOURCE
) -> DataFrame:
    return union_tables(
        brazil_province(brazil, provinces, forms["brazil"]), usa_province(usa, forms["usa"])
    ).select(*FACT_PROVINCE.names)
