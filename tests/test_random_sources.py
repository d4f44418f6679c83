"""Random sources with gaps, repeated days, copies, nulls and bad dates, against plain loops."""

import datetime as dt
import random

import pytest
from conftest import day, rows

from daytally import schemas
from daytally.functions import to_mdy
from daytally.plans import facts
from daytally.sources import choose_form


def _read(text):
    try:
        return dt.datetime.strptime(text, "%m/%d/%Y").date() if text else None
    except ValueError:
        return None


def _minus(a, b):
    return None if a is None or b is None else a - b


def _sum(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def _by_group(pairs):
    """Sum the columns of (key, values) by key."""
    groups = {}
    for key, values in pairs:
        groups.setdefault(key, []).append(values)
    return sorted((*k, *[_sum(c) for c in zip(*v)]) for k, v in groups.items())


def world_rows(seed):
    rng = random.Random(seed)
    out = set()
    for _ in range(1500):
        country = rng.choice(["A", "B", "Brazil", "US", None])
        place = rng.choice(["p", "q", "r", None])
        text = rng.choice([to_mdy(day(rng.randint(1, 9)))] * 12 + ["x", None, "01/02/2024"])
        out.add((text, country, "s", "i", "j", rng.choice(["Confirmed", "Deaths", "Other", None]),
                 rng.choice([None, 0, 1, 2]), rng.randint(1, 2), place))
    return sorted(out, key=str)


def world_pairs(data):
    """(country, day, type, increment, count) for every pair of rows a day apart."""
    named = [(r[5], r[1], r[8], _read(r[0]), r[6]) for r in data]
    named = [r for r in named if None not in r[:4]]
    for kind, country, place, d, n in named:
        if kind == "Other" or (kind == "Deaths" and country in ("Brazil", "US")):
            continue
        for kind2, country2, place2, d2, n2 in named:
            if (kind, country, place) == (kind2, country2, place2) and (d - d2).days == 1:
                yield country, d, kind, _minus(n, n2), n


def spread_out(pairs):
    for country, d, kind, delta, n in pairs:
        values = (delta, None, n, None) if kind == "Confirmed" else (None, delta, None, n)
        yield (country, d), values


@pytest.mark.parametrize("seed", range(3))
def test_world_facts(spark, tmp_path, seed):
    data = world_rows(seed)
    df = spark.createDataFrame(data, schemas.WORLD)
    pairs = list(world_pairs(data))
    once, each = _by_group(spread_out(set(pairs))), _by_group(spread_out(pairs))
    assert once != each
    form = choose_form(facts.world_days(df), facts.WORLD_KEYS, "day", str(tmp_path / "r"))
    for how in ("join", form):
        assert sorted(map(tuple, facts.world_country(df, how=how).collect())) == once
        assert sorted(map(tuple, facts.world_country(df, places="each", how=how).collect())) == each


@pytest.mark.parametrize("seed", range(3))
def test_province_and_country_facts(spark, tmp_path, seed):
    rng = random.Random(seed)
    data = sorted({
        (rng.choice([day(rng.randint(1, 9))] * 9 + [None]), rng.choice(["SP", "SP ", "RJ", "XX", None]),
         rng.choice(["state", "state", "city"]), rng.choice([None, *range(5)]), rng.randint(0, 3), 1)
        for _ in range(120)}, key=str)
    names = [("SP", "South"), (" RJ", "Rio"), ("RJ", "Rio again"), (None, "Nowhere")]
    states = [r for r in data if r[2] == "state" and None not in r[:2]]
    pairs = [(a[1], a[0], _minus(a[3], b[3]), a[4] - b[4], a[3], a[4])
             for a in states for b in states if a[1] == b[1] and (a[0] - b[0]).days == 1]
    province = {("Brazil", name, *p[1:]) for p in pairs for key, name in names
                if key and key.strip() == p[0].strip()}
    country = _by_group((("Brazil", p[1]), p[2:]) for p in pairs)
    brazil = spark.createDataFrame(data, schemas.BRAZIL)
    lookup = spark.createDataFrame(names, schemas.PROVINCES)
    form = choose_form(facts.brazil_states(brazil), facts.BRAZIL_KEYS, "date", str(tmp_path / "r"))
    for how in ("join", form):
        got = rows(facts.brazil_province(brazil, lookup, how))
        assert got == sorted(province, key=lambda r: [(x is not None, x) for x in r])
        assert sorted(map(tuple, facts.brazil_country(brazil, how).collect())) == country
