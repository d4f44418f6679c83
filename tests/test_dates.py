import datetime as dt

from conftest import day
from pyspark.sql import functions as F

from daytally.functions import date_parts, date_text, parse_mdy, to_mdy


def test_parse_and_parts(spark):
    texts = ["1/2/2024", "01/02/2024", "12/31/2020", "13/1/2024", "2/30/2024", "5/19", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parts = date_parts(F.col("t"))
    got = df.select(parse_mdy(F.col("t")), parts["month"], parts["day"], parts["year"]).collect()
    assert [r[0] for r in got] == [day(2), day(2), dt.date(2020, 12, 31)] + [None] * 6
    assert tuple(got[0])[1:] == ("01", "02", "2024")
    assert tuple(got[5])[1:] == ("05", "19", None)
    assert tuple(got[8])[1:] == (None, None, None)


def test_text_of_a_date(spark):
    df = spark.createDataFrame([(day(2),)], "d date")
    row = df.select(date_text(F.col("d")), date_text(F.col("d"), "MM/dd/yyyy")).first()
    assert tuple(row) == ("2024-01-02", "01/02/2024")
    assert to_mdy(dt.date(2020, 5, 9)) == "5/9/2020"


def test_a_day_without_a_midnight_is_still_that_day(spark):
    """Clocks in this zone skipped from 23:59 to 01:00 on the night before."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("10/16/2011",)], "t string").select(parse_mdy(F.col("t")))
        assert df.first()[0] == dt.date(2011, 10, 16)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
