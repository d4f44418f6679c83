import datetime as dt

import pytest
from conftest import day, rows

from daytally import schemas
from daytally.functions import to_mdy
from daytally.plans import dims, facts

AS_OF = day(3)


def world(spark, data):
    """Rows (country, place, type, day, cases), spelled out to the world file's columns."""
    return spark.createDataFrame(
        [(to_mdy(d) if isinstance(d, dt.date) else d, c, p, f"{c}2", f"{c}3", t, n, 1000, f"{c}/{p}")
         for c, p, t, d, n in data], schemas.WORLD)


def brazil(spark, data):
    """Rows (state, level, day, confirmed, deaths, population)."""
    return spark.createDataFrame(
        [(d, s, level, c, x, p) for s, level, d, c, x, p in data], schemas.BRAZIL)


def lookup(spark, *pairs):
    return spark.createDataFrame(pairs, schemas.PROVINCES)


TWO_PLACES = [
    ("A", "p", "Confirmed", day(1), 1), ("A", "p", "Confirmed", day(2), 4),
    ("A", "q", "Confirmed", day(1), 1), ("A", "q", "Confirmed", day(2), 4),
    ("A", "r", "Confirmed", day(1), 2), ("A", "r", "Confirmed", day(2), 4),
    ("A", "p", "Deaths", day(1), 0), ("A", "p", "Deaths", day(2), 1),
]


@pytest.mark.parametrize("how", ["join", "lag"])
def test_places_that_agree_count_once_unless_each_is_asked_for(spark, how):
    df = world(spark, TWO_PLACES)
    assert rows(facts.world_country(df, how=how)) == [("A", day(2), 5, 1, 8, 1)]
    assert rows(facts.world_country(df, places="each")) == [("A", day(2), 8, 1, 12, 1)]


def test_detailed_countries_lose_deaths_and_optionally_confirmed(spark):
    data = [(c, "p", t, day(n), n) for c in ("Brazil", "US", "A") for n in (1, 2)
            for t in ("Confirmed", "Deaths", "Recovered")]
    df = world(spark, data)
    assert rows(facts.world_country(df)) == [
        ("A", day(2), 1, 1, 2, 2), ("Brazil", day(2), 1, None, 2, None),
        ("US", day(2), 1, None, 2, None),
    ]
    only_a = facts.world_country(df, no_confirmed=facts.DETAILED)
    assert rows(only_a) == [("A", day(2), 1, 1, 2, 2)]


def test_both_passes_at_once_equal_the_two_tables(spark):
    df = world(spark, TWO_PLACES + [("B", "p", "Deaths", day(n), n * n) for n in range(1, 6)])
    parts = facts.world_confirmed(df).unionByName(facts.world_deaths(df))
    merged = parts.groupBy("country_name", "date").agg(
        *[facts.F.sum(m).alias(m) for m in schemas.MEASURES])
    assert rows(facts.world_country(df)) == rows(merged)


def test_repeated_days_give_every_pair_once(spark):
    df = world(spark, [("A", "p", "Confirmed", day(1), n) for n in (1, 2)]
               + [("A", "p", "Confirmed", day(2), n) for n in (5, 6)])
    got = facts.world_confirmed(df).select("confirmed_cases", "sum_confirmed_cases")
    assert rows(got) == [(3, 5), (4, 5), (4, 6), (5, 6)]
    assert rows(facts.world_country(df)) == [("A", day(2), 16, None, 22, None)]


def test_copies_differing_elsewhere_do_not_multiply(spark):
    df = world(spark, [("A", "p", "Confirmed", day(n), n) for n in (1, 2)])
    other = df.withColumn("population_count", facts.F.lit(7).cast("bigint"))
    assert rows(facts.world_country(df.unionByName(other))) == [("A", day(2), 1, None, 2, None)]


def test_a_third_of_all_rows_on_one_place_and_day(spark):
    """Copies of a reading that differ elsewhere meet as one row, not as 10 billion pairs."""
    hot = spark.range(100_000).select(
        facts.F.explode(facts.F.array(*[facts.F.lit(to_mdy(day(n))) for n in (1, 2)])).alias("date"),
        facts.F.lit("A").alias("country_region"), facts.F.lit("p").alias("combined_key"),
        facts.F.lit("Deaths").alias("case_type"), facts.F.lit(3).cast("bigint").alias("cases"),
        facts.F.col("id").alias("population_count"))
    assert rows(facts.world_country(hot)) == [("A", day(2), None, 0, None, 3)]
    assert rows(facts.world_country(hot, places="each")) == [("A", day(2), None, 0, None, 3 * 10**10)]


def test_malformed_date_text_has_no_increment(spark):
    df = world(spark, [("A", "p", "Confirmed", "1/1/2024", 1), ("A", "p", "Confirmed", "1-2-2024", 2),
                       ("A", "p", "Confirmed", "01/02/2024", 5)])
    assert rows(facts.world_country(df)) == [("A", day(2), 4, None, 5, None)]


BRAZIL_ROWS = [
    ("SP", "state", day(2), 10, 1, 100), ("SP", "state", day(3), 15, 1, 100),
    ("SP", "city", day(2), 3, 0, 10), ("SP", "city", day(3), 4, 0, 10),
    ("MA", "state", day(2), 2, 0, 50), ("MA", "state", day(3), 1, 0, 50),
    ("XX", "state", day(2), 1, 0, 7), ("XX", "state", day(3), 1, 0, 7),
]


@pytest.mark.parametrize("how", ["join", "lag"])
def test_brazil_trims_for_the_fact_but_not_for_the_dimension(spark, how):
    df, names = brazil(spark, BRAZIL_ROWS), lookup(spark, ("SP", "Sao Paulo"), (" MA ", "Maranhao"))
    assert rows(facts.brazil_province(df, names, how)) == [
        ("Brazil", "Maranhao", day(3), -1, 0, 1, 0), ("Brazil", "Sao Paulo", day(3), 5, 0, 15, 1),
    ]
    assert rows(facts.brazil_country(df)) == [("Brazil", day(3), 4, 0, 17, 1)]
    assert rows(dims.dim_province_brazil(df, names, AS_OF)) == [("Brazil", "Sao Paulo", 100)]


def test_brazil_dimension_sums_over_states_sharing_a_name(spark):
    names = lookup(spark, ("SP", "South"), ("MA", "South"), ("MA", "North"))
    got = dims.dim_province_brazil(brazil(spark, BRAZIL_ROWS), names, AS_OF)
    assert rows(got) == [("Brazil", "North", 50), ("Brazil", "South", 150)]


def test_usa_states_of_one_name_stay_apart_by_code(spark):
    data = [(day(n), "Ohio", code, n * step, 0) for n in (1, 2) for code, step in (("1", 2), ("2", 5))]
    df = spark.createDataFrame(data, schemas.USA)
    assert rows(facts.usa_province(df)) == [
        ("United States", "Ohio", day(2), 2, 0, 4, 0), ("United States", "Ohio", day(2), 5, 0, 10, 0),
    ]
    assert rows(facts.usa_country(df)) == [("United States", day(2), 7, 0, 14, 0)]


def test_country_sums_over_repeated_days_count_every_pair(spark):
    data = [(day(1), "Ohio", "1", 1, None), (day(1), "Ohio", "1", 2, None), (day(2), "Ohio", "1", 5, 1),
            (day(2), "Ohio", "1", None, 2)]
    got = facts.usa_country(spark.createDataFrame(data, schemas.USA))
    assert rows(got) == [("United States", day(2), 7, None, 10, 6)]


def test_dimensions(spark):
    df = world(spark, [("US", "p", "Deaths", AS_OF, 1), ("US", "q", "Deaths", AS_OF, 1),
                       ("US", "p", "Deaths", day(4), 1), ("US", "p", "Confirmed", AS_OF, 1),
                       ("Brazil", "s", "Deaths", day(5), 1), ("A", None, "Deaths", AS_OF, 1)])
    assert rows(dims.dim_country(df, AS_OF)) == [("A", "A2", "A3", 1000), ("US", "US2", "US3", 2000)]
    usa = df.withColumn("province_state", facts.F.lit("Ohio"))
    assert rows(dims.dim_province_usa(usa, AS_OF)) == [("US", "Ohio", 1000)]
    assert rows(dims.dim_province_usa(usa, AS_OF, population="sum")) == [("US", "Ohio", 2000)]
    assert rows(dims.dim_time(df)) == [("1/5/2024", "2024", 1, "01", "05", 6, day(5))]
    assert [r[0] for r in rows(dims.dim_time(df, None))] == ["1/3/2024", "1/4/2024", "1/5/2024"]


def test_week_of_a_year_s_first_days(spark):
    df = world(spark, [("Brazil", "s", "Deaths", "1/1/2021", 1), ("Brazil", "s", "Deaths", "x", 1)])
    assert rows(dims.dim_time(df), "date", "week", "week_day", "date_key") == [
        ("1/1/2021", 53, 6, dt.date(2021, 1, 1)), ("x", None, None, None)]
