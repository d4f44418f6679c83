"""Gaps, falling series, levels and analyses against plain loops; buckets by their plan."""

import math
import random
import re

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from daytally.operators import daily_delta, risen_delta, spread_delta
from daytally.plans import analyses
from daytally.plans.levels import fact_levels
from daytally.schemas import FACT_COUNTRY, FACT_PROVINCE, _struct
from daytally.sources import land_bucketed

SERIES = _struct("place string, date date, cases bigint")


def series(spark, found):
    return spark.createDataFrame([(p, day(n), v) for p, days in found.items() for n, v in days.items()], SERIES)


def test_gaps_are_spread(spark):
    df = series(spark, {"a": {1: 5, 2: 7, 5: 15, 6: 12}, "b": {3: None, 4: 2}, None: {1: 1, 2: 2}, "c": {1: 0, 4: -5}})
    got = rows(spread_delta(df, ["place"], "date", ["cases"]), "place", "date", "gap", "cases", "cases_delta")
    assert got == [
        ("a", day(1), 1, 5, 5), ("a", day(2), 1, 7, 2), ("a", day(3), 3, 9, 2), ("a", day(4), 3, 12, 3), ("a", day(5), 3, 15, 3), ("a", day(6), 1, 12, -3),
        ("b", day(3), 1, None, None), ("b", day(4), 1, None, None),
        ("c", day(1), 1, 0, 0), ("c", day(2), 3, -2, -2), ("c", day(3), 3, -4, -2), ("c", day(4), 3, -5, -1)]
    later = spread_delta(df, ["place"], "date", ["cases"], first=False)
    assert rows(later, "place", "date") == [r[:2] for r in got if r[1] != day(1) and r[:2] != ("b", day(3))]
    assert spread_delta(df.limit(0), ["place"], "date", ["cases"]).count() == 0


def pools(values):
    blocks = []
    for before, value in zip([0, *values], values):
        blocks.append([value - before, 1])
        while len(blocks) > 1 and (blocks[-1][0] < 0 or blocks[-2][0] < 0):
            total, days = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += days
    return [math.floor(s * i / n) - math.floor(s * (i - 1) / n) for s, n in blocks for i in range(1, n + 1)]


@pytest.mark.parametrize("seed", range(3))
def test_falling_series_are_pooled(spark, seed):
    rng = random.Random(seed)
    found = {}
    for p in "abcdefgh":
        level, days = rng.randrange(5), {}
        for n in sorted(rng.sample(range(1, 40), rng.randrange(1, 30))):
            level += rng.choice([-9, -2, 0, 1, 1, 3, 8])
            days[n] = level
        found[p] = days
    got = rows(risen_delta(series(spark, found), ["place"], "date", ["cases"]), "place", "date", "cases_delta", "cases")
    want = []
    for p, days in found.items():
        total = 0
        for n, d in zip(days, pools(list(days.values()))):
            total += d
            want.append((p, day(n), d, total))
    assert got == sorted(want)
    assert all(r[2] >= 0 for r in got if found[r[0]][max(found[r[0]])] >= 0)


def test_rows_without_reading_key_or_date(spark):
    df = series(spark, {"a": {1: 3, 2: None, 3: 1}, None: {1: 1}})
    assert rows(risen_delta(df, ["place"], "date", ["cases"])) == [("a", day(1), 0, 0), ("a", day(3), 1, 1)]
    assert risen_delta(df.limit(0), ["place"], "date", ["cases"]).count() == 0


def test_all_levels_in_one_pass(spark):
    data = [("A", "x", day(1), 1, None, 0, 0), ("A", "x", day(32), 2, 1, 0, 0), ("A", None, day(1), 4, 1, 0, 0), ("B", "x", day(2), 8, 1, 0, 0)]
    df = spark.createDataFrame(data, FACT_PROVINCE)
    got = fact_levels(df)
    found = {(r["level"], r["country_name"], r["province_state"], r["month"]): (r["days"], r["confirmed_cases"], r["death_cases"]) for r in got.collect()}
    assert found[7, None, None, None] == (4, 15, 3) and found[6, None, None, day(1)] == (3, 13, 2)
    assert found[3, "A", None, None] == (3, 7, 2) and found[1, "A", None, None] == (1, 4, 1) and found[1, "A", "x", None] == (2, 3, 1)
    assert found[5, None, "x", None] == (3, 11, 2) and found[0, "A", "x", day(32)] == (1, 2, 1)
    text = fact_levels(df)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", text)) == 1 and "partial_sum" in text


def country(spark, found):
    return spark.createDataFrame(
        [(c, day(n), v[0], None, v[1], None) for c, days in found.items() for n, v in days.items()], FACT_COUNTRY)


def test_waves(spark):
    up = {1: 1, 2: 2, 3: 5, 4: 5, 5: 6, 7: 9, 8: 10, 9: 11, 10: 2, 11: None, 12: 4, 13: 5}
    got = rows(analyses.waves(country(spark, {"A": {n: (v, 0) for n, v in up.items()}, None: {1: (1, 1), 2: (2, 1)}})))
    assert got == [("A", day(2), day(3), 2, 7, 5), ("A", day(8), day(9), 2, 21, 11)]
    one = rows(analyses.waves(country(spark, {"A": {n: (v, 0) for n, v in up.items()}}), least=1), "first_date", "days")
    assert one == [(day(2), 2), (day(5), 1), (day(8), 2), (day(13), 1)]


def test_doubling_time(spark):
    found = {"A": {n: (0, 2 ** n) for n in range(1, 12)}, "B": {1: (0, 0), 2: (0, 5), 3: (0, 5), 12: (0, 7)}}
    got = {r[:2]: r[3] for r in rows(analyses.doubling_time(country(spark, found)), "country_name", "date", "sum_confirmed_cases", "doubling_days")}
    assert got["A", day(1)] is None and all(got["A", day(n)] == pytest.approx(1) for n in range(2, 12))
    assert [got["B", day(n)] for n in (1, 2, 3, 12)] == [None] * 4


def test_increments_of_a_bucketed_copy_need_no_shuffle(spark, tmp_path):
    df = series(spark, {p: {n: n * n for n in range(1, 9)} for p in "abcdefghij"})
    landed = land_bucketed(df.unionByName(df), str(tmp_path / "b"), ["place"], "date", 4)
    assert landed.count() == 80
    delta = daily_delta(landed, ["place"], "date", ["cases"], "lag")
    text = delta._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text
    assert rows(delta) == rows(daily_delta(df, ["place"], "date", ["cases"], "join"))
    per_place = landed.groupBy("place").agg(F.max("cases"))
    assert "Exchange" not in per_place._jdf.queryExecution().executedPlan().toString()


def test_several_measures_rise_each_by_itself(spark):
    schema = _struct("place string, date date, c bigint, x bigint")
    data = [("a", day(1), 5, None), ("a", day(2), 3, 4), ("a", day(3), None, None), ("a", day(4), 9, 3)]
    got = rows(risen_delta(spark.createDataFrame(data, schema), ["place"], "date", ["c", "x"]), "date", "c_delta", "x_delta", "c", "x")
    assert got == [(day(1), 1, None, 1, None), (day(2), 2, 1, 3, 1), (day(4), 6, 2, 9, 3)]
