import datetime as dt

from conftest import day, rows

from daytally import schemas
from daytally.plans import analyses, quality

FACTS = [
    ("A", day(1), 0, 0, 0, 0), ("A", day(2), 4, 1, 4, 1), ("A", day(3), 4, 1, 8, 2),
    ("United States", day(2), 5, None, 10, None), ("United States", day(3), 10, 5, 20, 5),
    ("B", day(3), 20, 0, 20, 0),
]


def fact(spark):
    return spark.createDataFrame(FACTS, schemas.FACT_COUNTRY)


def test_compare(spark):
    people = spark.createDataFrame(
        [("A", "a", "a", 150), ("A", "a", "b", 50), ("US", "u", "u", 1000), ("C", "c", "c", 1)],
        schemas.DIM_COUNTRY)
    got = analyses.compare_countries(fact(spark), people, day(3), {"United States": "US"})
    assert rows(got, "confirmed_rank", "country_name", "confirmed_per_100k", "deaths_per_100k") == [
        (1, "B", None, None), (2, "United States", 2000.0, 500.0), (3, "A", 4000.0, 1000.0)]
    assert analyses.compare_countries(fact(spark), people).count() == len(FACTS)


def test_spread(spark):
    assert rows(analyses.spread(fact(spark)), "country_name", "date", "days_since_first") == [
        ("A", day(1), -1), ("A", day(2), 0), ("A", day(3), 1), ("B", day(3), 0),
        ("United States", day(2), 0), ("United States", day(3), 1)]
    assert rows(analyses.countries_reached(fact(spark))) == [(day(2), 2, 2), (day(3), 1, 3)]


def test_rates(spark):
    assert rows(analyses.mortality_rate(fact(spark)).where("country_name = 'A'")) == [
        ("A", day(1), None), ("A", day(2), 0.25), ("A", day(3), 0.25)]
    assert rows(analyses.percent_increase(fact(spark)).where("date = '2024-01-03'")) == [
        ("A", day(3), 100.0, 100.0), ("B", day(3), None, None),
        ("United States", day(3), 100.0, None)]


def test_trace_filters_and_orders(spark):
    got = analyses.trace(fact(spark), "A", since=day(2), until=day(3)).collect()
    assert [r["date"] for r in got] == [day(2), day(3)]


def test_reports(spark):
    world = spark.createDataFrame(
        [(f"1/{n}/2024", c, "p", "", "", "Confirmed", n, 1, c) for c in ("A", "B") for n in (1, 2, 3)]
        + [("1/3/2024", "C", "p", "", "", "Confirmed", 1, 1, "C")], schemas.WORLD)
    assert rows(quality.source_report(world)) == [("countries", 3, 2, False), ("dates", 3, 2, False)]
    countries = spark.createDataFrame([(c, "", "", 1) for c in ("A", "US", "B")], schemas.DIM_COUNTRY)
    times = spark.createDataFrame(
        [(str(n), "", 1, "", "", 1, day(n)) for n in (0, 1, 2, 3)], schemas.DIM_TIME)
    lake = quality.lake_report(countries, times, fact(spark), {"United States": "US"})
    assert rows(lake) == [("countries", 3, 3, True), ("dates", 4, 3, True)]
    more = times.unionByName(times.withColumn("date_key", quality.F.lit(dt.date(2025, 1, 1))))
    assert rows(quality.lake_report(countries, more, fact(spark))) == [
        ("countries", 3, 3, True), ("dates", 5, 3, False)]
