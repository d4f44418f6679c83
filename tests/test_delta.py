import random
from collections import Counter, defaultdict

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from daytally.operators import daily_delta, distinct_delta, pair_totals
from daytally.sources import choose_form

SCHEMA = "k string, g string, date date, m bigint, x bigint"
FORMS = ["join", "lag", "range"]


def series(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("how", FORMS)
def test_first_day_and_gaps_have_no_increment(spark, how):
    df = series(spark, [
        ("a", "g", day(1), 5, 0), ("a", "g", day(2), 9, 1), ("a", "g", day(4), 20, 1),
        ("a", "g", day(5), 18, 1), ("b", "g", day(2), 3, 0),
    ])
    got = daily_delta(df, ["k", "g"], "date", ["m", "x"], how)
    assert got.columns == ["k", "g", "date", "m_delta", "x_delta", "m", "x"]
    assert rows(got) == [
        ("a", "g", day(2), 4, 1, 9, 1), ("a", "g", day(5), -2, 0, 18, 1),
    ]


@pytest.mark.parametrize("how", FORMS)
def test_crosses_month_and_year_ends(spark, how):
    df = series(spark, [("a", "g", day(n), n * n, 0) for n in (31, 32, 366, 367)])
    assert rows(daily_delta(df, ["k", "g"], "date", ["m"], how), "date", "m_delta") == [
        (day(32), 63), (day(367), 733),
    ]


@pytest.mark.parametrize("how", FORMS)
def test_null_keys_and_dates_never_match_and_null_counts_stay(spark, how):
    df = series(spark, [
        (None, "g", day(1), 1, 1), (None, "g", day(2), 2, 2), ("a", None, day(1), 1, 1),
        ("a", None, day(2), 2, 2), ("a", "g", None, 1, 1), ("b", "g", day(1), None, 1),
        ("b", "g", day(2), 7, 2), ("b", "g", day(3), None, 4),
    ])
    got = daily_delta(df, ["k", "g"], "date", ["m", "x"], how)
    assert rows(got, "k", "date", "m_delta", "x_delta", "m") == [
        ("b", day(2), None, 1, 7), ("b", day(3), None, 2, None),
    ]


def test_join_form_pairs_repeated_days(spark):
    df = series(spark, [("a", "g", day(1), 1, 0), ("a", "g", day(1), 2, 0),
                        ("a", "g", day(2), 5, 0), ("a", "g", day(2), 5, 0)])
    got = daily_delta(df, ["k", "g"], "date", ["m"], "join")
    assert rows(got, "m_delta", "m") == [(3, 5), (3, 5), (4, 5), (4, 5)]


def test_unknown_form_is_refused(spark):
    with pytest.raises(ValueError, match="how must be"):
        daily_delta(series(spark, []), ["k"], "date", ["m"], "merge")
    with pytest.raises(ValueError, match="how must be"):
        distinct_delta(series(spark, []), ["k"], "date", ["m"], "range")


def _random_rows(seed, repeated):
    rng = random.Random(seed)
    out = []
    for k in ["a", "b", "c", None]:
        for g in ["g", "h", None]:
            for n in range(1, 15):
                for _ in range(rng.choice([0, 1, 1, 3] if repeated else [0, 1, 1])):
                    m = rng.choice([None, rng.randint(-5, 50)])
                    out.append((k, g, day(n), m, rng.randint(0, 9)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_forms_agree_on_unique_days(spark, seed):
    df = series(spark, _random_rows(seed, repeated=False))
    answers = [rows(daily_delta(df, ["k", "g"], "date", ["m", "x"], how)) for how in FORMS]
    assert answers[0] and answers[0] == answers[1] == answers[2]


@pytest.mark.parametrize("seed", range(3))
def test_splitting_off_repeated_keys_changes_no_row(spark, tmp_path, seed):
    steady = [r for r in _random_rows(seed, repeated=False) if r[0] != "a"]
    data = steady + [r for r in _random_rows(seed, repeated=True) if r[0] == "a"]
    days = Counter(r[:3] for r in data if None not in r[:2])
    repeated = sorted({key[:2] for key, n in days.items() if n > 1})
    df = series(spark, data)
    args = (df, ["k", "g"], "date", ["m", "x"])
    form = choose_form(df, ["k", "g"], "date", str(tmp_path / "repeated"))
    assert repeated and rows(form) == repeated
    whole = rows(daily_delta(*args, "join").distinct())
    assert whole and rows(distinct_delta(*args, form).distinct()) == whole
    assert rows(distinct_delta(*args, "join").distinct()) == whole


def test_repeated_keys_are_split_off_whatever_their_number(spark, tmp_path):
    df = series(spark, [(k, "g", day(1), n, 0) for k in "abc" for n in (1, 2)])
    choose = lambda df: choose_form(df, ["k", "g"], "date", str(tmp_path / "repeated"))
    assert choose(df).count() == 3
    assert choose(df.where("m = 1")) == "lag"


def _sum(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def test_totals_in_a_form_for_the_source(spark, tmp_path):
    steady = [r for r in _random_rows(5, repeated=False) if r[0] != "a"]
    df = series(spark, steady + [r for r in _random_rows(5, repeated=True) if r[0] == "a"])
    form = choose_form(df, ["k", "g"], "date", str(tmp_path / "repeated"))
    args = (["k", "g"], "date", ["m", "x"])
    assert rows(pair_totals(df, *args, form)) == rows(pair_totals(df, *args))
    alone = series(spark, steady)
    assert rows(pair_totals(alone, *args, "lag")) == rows(pair_totals(alone, *args))
    with pytest.raises(ValueError, match="how must be"):
        pair_totals(df, *args, "range")


@pytest.mark.parametrize("seed", range(3))
def test_pair_totals_are_the_sums_over_all_pairs(spark, seed):
    data = _random_rows(seed, repeated=True)
    pairs = defaultdict(list)
    for k, g, d, m, x in data:
        for k2, g2, d2, m2, x2 in data:
            if None not in (k, g) and (k, g) == (k2, g2) and (d - d2).days == 1:
                delta = None if m is None or m2 is None else m - m2
                pairs[k, g, d].append((delta, x - x2, m, x))
    want = sorted(key + tuple(_sum(c) for c in zip(*p)) for key, p in pairs.items())
    got = pair_totals(series(spark, data), ["k", "g"], "date", ["m", "x"])
    assert got.columns == ["k", "g", "date", "m_delta", "x_delta", "m", "x"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_pair_totals_of_a_place_with_most_rows(spark):
    """One place and day with 20,000 readings: 400 million pairs, never made."""
    n = 20_000
    hot = spark.range(n).select(
        F.lit("hot").alias("k"), F.lit("g").alias("g"),
        F.explode(F.array(F.lit(day(1)), F.lit(day(2)))).alias("date"),
        F.col("id").alias("m"), F.lit(1).cast("bigint").alias("x"),
    )
    total = n * n * (n - 1) // 2
    assert rows(pair_totals(hot, ["k", "g"], "date", ["m", "x"])) == [
        ("hot", "g", day(2), 0, 0, total, n * n),
    ]
