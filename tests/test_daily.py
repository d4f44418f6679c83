"""Loads of new days against one load of all, and landings by file."""

import os
import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from daytally.operators import daily_delta, late_keys
from daytally.plans import daily
from daytally.plans.daily import DailyIncrements
from daytally.schemas import _struct
from daytally.sources import LandedFiles, read_csv

READINGS = _struct("kind string, place string, date date, cases bigint, deaths bigint")
KEYS, MEASURES = ["kind", "place"], ["cases", "deaths"]


def readings(spark, found):
    return spark.createDataFrame([(*k, day(n), *v) for (k, n), v in found.items()], READINGS)


def loaded(spark, path, loads):
    table = DailyIncrements(spark, path, READINGS, KEYS, "date", MEASURES)
    for load in loads:
        table.load(readings(spark, load))
    return table


@pytest.mark.parametrize("seed", range(3))
def test_loads_of_days_equal_one_load(spark, tmp_path, seed):
    """Gaps, new places, days that come late and days that come again with another reading."""
    rng = random.Random(seed)
    keys = [(k, p) for k in "ab" for p in "xyz"]
    loads, everything = [], {}
    for number in range(5):
        load = {}
        for key in keys[: 3 + number]:
            for n in range(4 * number + 1, 4 * number + 5):
                if rng.random() < 0.8:
                    load[key, n] = (rng.randrange(100), rng.choice([None, 1, 2]))
            if number and rng.random() < 0.3:
                load[key, rng.randrange(1, 4 * number)] = (rng.randrange(100), 5)
        loads.append(load)
        everything |= load
    table = loaded(spark, str(tmp_path / "t"), loads)
    want = daily_delta(readings(spark, everything), KEYS, "date", MEASURES, "join")
    got = table.increments()
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 20
    first = daily_delta(readings(spark, loads[0]), KEYS, "date", MEASURES, "join")
    assert rows(table.increments(1)) == rows(first)


def test_a_load_reads_its_rows_and_the_state_only(spark, tmp_path, monkeypatch):
    days = [{(("a", p), n): (n, 0) for p in "xyz"} for n in range(1, 5)]
    table = loaded(spark, str(tmp_path / "t"), days[:3])
    read = []

    def watched(spark, path, parts, schema):
        read.extend(p.path.split("/")[-1] for p in parts)
        return daily_read(spark, path, parts, schema)

    daily_read = daily.read_parts
    monkeypatch.setattr(daily, "read_parts", watched)
    table.load(readings(spark, days[3]))
    assert read == ["state"]
    table.load(readings(spark, {(("a", "x"), 2): (7, 0)}))
    assert "readings" in read
    got = [r for r in rows(table.increments()) if r[1] == "x"]
    assert [(r[2], r[3]) for r in got] == [(day(2), 6), (day(3), -4), (day(4), 1)]


def test_state_and_late_keys(spark):
    state = readings(spark, {(("a", "x"), 5): (1, 1), (("a", "y"), 2): (1, 1)})
    new = readings(spark, {(("a", "x"), 5): (2, 2), (("a", "y"), 3): (1, 1), (("a", "z"), 1): (1, 1)})
    assert rows(late_keys(new, state, KEYS, "date")) == [("a", "x")]


def test_rows_without_key_or_date_and_empty_loads(spark, tmp_path):
    table = DailyIncrements(spark, str(tmp_path / "t"), READINGS, KEYS, "date", MEASURES)
    assert table.increments().count() == 0
    table.load(spark.createDataFrame([], READINGS))
    table.load(spark.createDataFrame([(None, "x", day(1), 1, 1), ("a", "x", None, 1, 1), ("a", "x", day(1), 1, 1)], READINGS))
    table.load(spark.createDataFrame([("a", "x", day(2), 3, None)], READINGS))
    assert rows(table.increments()) == [("a", "x", day(2), 2, None, 3, None)]


def test_landing_reads_new_and_changed_files_only(spark, tmp_path):
    schema, source = _struct("a bigint, b string"), tmp_path / "in put+ü"
    source.mkdir()
    asked = []

    def read(spark, paths):
        asked.append(sorted(os.path.basename(p) for p in paths))
        return read_csv(spark, paths, schema)

    def put(name, *values):
        (source / name).write_text("a,b\n" + "".join(f"{v},{name}\n" for v in values))

    def report(df):
        return {r["status"]: r["files"] for r in df.collect()}

    landed = LandedFiles(spark, str(tmp_path / "landed"), schema, read)
    assert landed.rows().count() == 0
    put("one 1%.csv", 1, 2)
    put("two[1].csv", 3)
    put("none.csv")
    assert report(landed.land(str(source))) == {"new": 3}
    assert rows(landed.rows()) == [(1, "one 1%.csv"), (2, "one 1%.csv"), (3, "two[1].csv")]
    assert report(landed.land(str(source))) == {"same": 3} and len(asked) == 1
    put("two[1].csv", 30, 31)
    put("three.csv", 5)
    os.remove(source / "one 1%.csv")
    assert report(landed.land(str(source))) == {"same": 1, "changed": 1, "new": 1, "withdrawn": 1}
    assert asked[1] == ["three.csv", "two\\[1\\].csv"]
    assert rows(landed.rows()) == [(5, "three.csv"), (30, "two[1].csv"), (31, "two[1].csv")]
    assert rows(landed.rows(1), "a") == [(1,), (2,), (3,)]
    put("one 1%.csv", 9)
    landed.land(str(source))
    assert rows(landed.rows(), "a") == [(5,), (9,), (30,), (31,)]


def test_landing_that_breaks_off_changes_nothing(spark, tmp_path):
    schema, source = _struct("a bigint"), tmp_path / "in"
    source.mkdir()
    (source / "x.csv").write_text("a\n1\n")

    def broken(spark, paths):
        raise OSError("gone")

    landed = LandedFiles(spark, str(tmp_path / "landed"), schema, lambda s, p: read_csv(s, p, schema))
    landed.land(str(source))
    (source / "y.csv").write_text("a\n2\n")
    with pytest.raises(OSError):
        LandedFiles(spark, str(tmp_path / "landed"), schema, broken).land(str(source))
    assert rows(landed.rows()) == [(1,)]
    landed.land(str(source))
    assert rows(landed.rows()) == [(1,), (2,)]
