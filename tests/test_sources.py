import datetime as dt
import gzip

import pytest
from conftest import day, rows

from daytally import schemas
from daytally.sources import (
    input_check, land, load_snapshot, read_csv, read_inferred, read_json, repeated_days,
)


def test_csv_by_header_name_in_any_order(spark, tmp_path):
    file = tmp_path / "b.csv"
    file.write_text(
        "city,STATE,place_type,date,last_available_deaths,last_available_confirmed,"
        "estimated_population_2019\n"
        "X,SP,city,2020-05-19,1,12.0,9\n"
        "\"A, b\",RJ,state,2020-05-20,,n/a,8\n"
        ",,state,not a date,3,4,5\n"
    )
    df = read_csv(spark, str(file), schemas.BRAZIL)
    assert df.schema == schemas.BRAZIL
    assert [tuple(r) for r in df.collect()] == [
        (dt.date(2020, 5, 19), "SP", "city", 12, 1, 9),
        (dt.date(2020, 5, 20), "RJ", "state", None, None, 8),
        (None, None, "state", 4, 3, 5),
    ]


def test_csv_without_a_declared_column_is_refused(spark, tmp_path):
    (tmp_path / "p.csv").write_text("state\nSP\n")
    with pytest.raises(ValueError, match="province_state"):
        read_csv(spark, str(tmp_path / "p.csv"), schemas.PROVINCES)


def test_csv_folder_with_two_column_orders_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("state,province_state\nSP,Sao Paulo\n")
    (tmp_path / "b.csv").write_text("province_state,state\nRio,RJ\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), schemas.PROVINCES).collect()


def test_gzip_keeps_blanks_and_spreads(spark, tmp_path):
    path = tmp_path / "p.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("state,province_state\n" + "".join(f" S{i} ,Name {i}\n" for i in range(100)))
    df = read_csv(spark, str(path), schemas.PROVINCES, spread=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 100 and df.where("state = ' S7 '").count() == 1


def test_json_by_name(spark, tmp_path):
    (tmp_path / "part-1.json").write_text(
        '{"date": "2024-01-02", "state_name": "Ohio", "state_fips": 39, "cases": 5, "more": [1]}\n'
    )
    (tmp_path / "part-2.json").write_text(
        '{"date": "2024-01-03", "state_name": "Ohio", "state_fips": "39", "cases": 7, "deaths": 1}\n'
    )
    df = read_json(spark, str(tmp_path / "part-*.json"), schemas.USA)
    assert df.schema == schemas.USA
    assert rows(df) == [(day(2), "Ohio", "39", 5, None), (day(3), "Ohio", "39", 7, 1)]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Date,Cases,day\n5/19/2020,3,2020-05-19\n")
    types = dict(read_inferred(spark, str(tmp_path / "w.csv")).dtypes)
    assert types == {"Date": "string", "Cases": "int", "day": "date"}
    (tmp_path / "u.json").write_text('{"cases": 3}\n')
    assert read_inferred(spark, str(tmp_path / "u.json"), "json").dtypes == [("cases", "bigint")]


def test_landing_drops_copies_and_can_be_repeated(spark, tmp_path):
    raw = spark.createDataFrame([("a", "x")] * 50 + [("a", "y"), (None, "x"), (None, "x")],
                                schemas.PROVINCES)
    path = str(tmp_path / "snap")
    for _ in range(2):
        assert rows(land(raw, path)) == [(None, "x"), ("a", "x"), ("a", "y")]
    assert load_snapshot(spark, path, schemas.PROVINCES).count() == 3


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", day(1)), ("a", day(1)), ("a", day(2)), (None, day(1)), (None, day(1))],
        "k string, date date",
    )
    assert rows(input_check(df, ["K", "z"], ["k", "date"])) == [
        ("column:K", 1, True), ("column:z", 0, False), ("nulls:date", 0, True),
        ("nulls:k", 2, False), ("rows", 5, True),
    ]
    assert rows(input_check(df.limit(0), [], ["k"])) == [("nulls:k", 0, True), ("rows", 0, False)]
    assert repeated_days(df, ["k"], "date").first()[0] == 1
    assert repeated_days(df.limit(0), ["k"], "date").first()[0] == 0


def test_json_fields_by_name_whatever_their_case(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"Date": "2024-01-01", "State_Name": "X", "STATE_FIPS": "7", "Cases": 9007199254740993, "deaths": "12.7"}\n')
    row = read_json(spark, str(tmp_path / "c.json"), schemas.USA).first()
    assert (row.state_name, row.cases, row.deaths) == ("X", 2 ** 53 + 1, None)
    (tmp_path / "d.json").write_text('{"date": "2024-01-01", "state_name": "X", "state_fips": "7", "count": 3}\n')
    with pytest.raises(ValueError, match="lacks the columns"):
        read_json(spark, str(tmp_path / "d.json"), schemas.USA)
