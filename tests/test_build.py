import datetime as dt
import glob
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import day, rows
from pyspark.errors import AnalysisException

from daytally import schemas
from daytally.functions import to_mdy
from daytally.plans import build
from daytally.plans.build import (
    Sources, build_lake, check_inputs, compact_lake, increment_forms, land_sources, open_lake,
)
from daytally.plans.sketches import sketch_lake, sketched_counts
from daytally.sinks import LakeChanged, commit, read_version, remove_old, roll_back, write_table

WORLD_HEAD = ("Country_Region,Province_State,iso2,iso3,Case_Type,Cases,Population_Count,"
              "Combined_Key,Date,Difference\n")


def raw(folder, days, header_only=False):
    folder.mkdir()
    world = [
        f"{c},P,{c}2,{c}3,{t},{n * step},100,\"P, {c}\",{to_mdy(day(n))},0\n"
        for c, step in (("Brazil", 3), ("US", 4), ("Chile", 5))
        for t in ("Confirmed", "Deaths") for n in days
    ]
    (folder / "world.csv").write_text(WORLD_HEAD + "".join([] if header_only else world * 2))
    (folder / "brazil.csv").write_text(
        "city,date,state,place_type,last_available_confirmed,last_available_deaths,"
        "estimated_population_2019\n"
        + "".join(f",{day(n)},SP,state,{n * 2},{n},45\n" for n in days))
    (folder / "provinces.csv").write_text("state,province_state\nSP,Sao Paulo\n")
    (folder / "usa.json").write_text("".join(
        f'{{"date": "{day(n)}", "state_name": "Ohio", "state_fips": "39", "cases": {n * 7}, '
        f'"deaths": {n}}}\n' for n in days))
    return Sources(*[str(folder / f) for f in
                     ("world.csv", "brazil.csv", "provinces.csv", "usa.json")])


def test_run_twice_then_from_a_day_on(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    sources = raw(tmp_path / "in1", range(1, 5))
    for _ in range(2):
        report = build_lake(spark, sources, snapshot, lake, as_of=day(2))
    assert rows(report) == [
        ("countries", 3, 3, True), ("dates", 4, 3, True), ("province_dates", 4, 3, True), ("provinces", 2, 2, True),
        ("source:brazil", 1, 1, True), ("source:usa", 1, 1, True), ("source:world", 3, 3, True)]
    tables = open_lake(spark, lake)
    country = rows(tables["fact_covid_country"])
    assert len(country) == 3 * 5  # three days; Brazil and USA from two sources each
    assert ("Brazil", day(2), 2, 1, 4, 2) in country
    assert ("Brazil", day(2), 3, None, 6, None) in country
    assert ("United States", day(2), 7, 1, 14, 2) in country
    assert ("Chile", day(2), 5, 5, 10, 10) in country
    assert rows(tables["fact_covid_country_province"], "country_name", "province_state") == (
        [("Brazil", "Sao Paulo")] * 3 + [("United States", "Ohio")] * 3)
    assert rows(tables["dim_country"]) == [
        (c, f"{c}2", f"{c}3", 100) for c in ("Brazil", "Chile", "US")]
    assert rows(tables["dim_province"]) == [("Brazil", "Sao Paulo", 45), ("US", "P", 100)]
    assert tables["dim_time"].count() == 4

    # Two more days arrive; loading from day 5 on equals building it all.
    more = raw(tmp_path / "in2", range(1, 7))
    for _ in range(2):
        build_lake(spark, more, snapshot, lake, as_of=day(2), since=day(5))
    whole = str(tmp_path / "whole")
    build_lake(spark, more, snapshot, whole, as_of=day(2))
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name


def test_load_from_a_later_month_on(spark, tmp_path):
    """Months before are not touched; the figures of the population day stay."""
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(20, 63)), snapshot, lake, as_of=day(22))
    old = {f: os.path.getmtime(f) for f in glob.glob(f"{lake}/runs/*/*/*/*/*.parquet") if "date=2024-01" in f
           or "year=2024/month=01" in f}
    more = raw(tmp_path / "in2", range(20, 70))
    build_lake(spark, more, snapshot, lake, as_of=day(22), since=day(63))
    assert old and all(os.path.getmtime(f) == t for f, t in old.items())
    late, = glob.glob(f"{snapshot}/since-*/usa")
    whole_copy, = glob.glob(f"{snapshot}/full-*/usa")
    first = [spark.read.parquet(f).agg({"date": "min"}).first()[0] for f in (late, whole_copy)]
    assert first == [day(61), day(20)]
    whole = str(tmp_path / "whole")
    build_lake(spark, more, snapshot, whole, as_of=day(22))
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name


def test_corrected_run_has_one_row_per_country_and_day(spark, tmp_path):
    lake = str(tmp_path / "lake")
    build_lake(spark, raw(tmp_path / "in", range(1, 4)), str(tmp_path / "s"), lake, day(2),
               corrected=True)
    got = rows(open_lake(spark, lake)["fact_covid_country"], "country_name", "date")
    assert got == [(c, day(n)) for c in ("Brazil", "Chile", "United States") for n in (2, 3)]


def test_empty_source_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="world"):
        build_lake(spark, raw(tmp_path / "in", range(1, 3), header_only=True),
                   str(tmp_path / "s"), str(tmp_path / "lake"))
    assert not (tmp_path / "lake").exists()


def test_form_follows_the_data(spark, tmp_path):
    path = str(tmp_path / "s")
    inputs = land_sources(spark, raw(tmp_path / "in", range(1, 3)), path)
    assert increment_forms(inputs, path) == {"world": "lag", "brazil": "lag", "usa": "lag"}
    again = inputs["usa"].withColumn("cases", inputs["usa"].cases + 1)
    forms = increment_forms({**inputs, "usa": inputs["usa"].unionByName(again)}, path)
    assert forms["brazil"] == "lag" and rows(forms["usa"]) == [("Ohio", "39")]
    checks = check_inputs(inputs)
    assert checks.where("not passed").count() == 0


def test_report_tells_a_state_that_the_lookup_lacks(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 4))
    with open(sources.brazil, "a") as f:
        f.writelines(f",{day(n)},RJ,state,{n},{n},5\n" for n in (1, 2, 3))
    report = build_lake(spark, sources, str(tmp_path / "s"), str(tmp_path / "lake"), day(2))
    assert rows(report.where("not passed")) == [("source:brazil", 2, 1, False)]


def test_report_reads_folders_only(spark, tmp_path):
    lake = str(tmp_path / "lake")
    build_lake(spark, raw(tmp_path / "in", range(1, 4)), str(tmp_path / "s"), lake, day(2))
    text = build.lake_quality(spark, lake)._jdf.queryExecution().executedPlan().toString()
    read = [s for s in re.findall(r"ReadSchema: (struct<.*?>)", text)]
    assert len(read) == 5 and read.count("struct<>") == 4  # the time dimension's key is no folder


def test_unreadable_values_are_counted_beside_the_copies(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 4))
    with open(sources.world, "a") as f:
        f.write("Chile,P,a,b,Deaths,many,100,x,2024/1/2,0\n")
    build_lake(spark, sources, str(tmp_path / "s"), str(tmp_path / "lake"), day(2))
    failed = spark.read.parquet(*glob.glob(f"{tmp_path}/s/*/checks")).where("not passed")
    assert rows(failed, "source", "check_name", "found") == [
        ("world", "nulls:cases", 1), ("world", "nulls:day", 1)]


def test_missing_file_stops_the_run(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 3))
    gone = Sources(sources.world, sources.brazil, sources.provinces, str(tmp_path / "none.json"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        build_lake(spark, gone, str(tmp_path / "s"), str(tmp_path / "lake"))
    assert not (tmp_path / "lake").exists()


def test_withdrawn_days_leave_the_lake(spark, tmp_path):
    """After a reload the folders from that day on are those of a full build."""
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(1, 8)), snapshot, lake, as_of=day(2))
    old = {f: os.path.getmtime(f) for n in range(2, 5)
           for f in glob.glob(f"{lake}/runs/*/fact*/**/date={day(n)}/*.parquet", recursive=True)}
    fewer = raw(tmp_path / "in2", range(1, 6))
    build_lake(spark, fewer, snapshot, lake, as_of=day(2), since=day(5))
    whole = str(tmp_path / "whole")
    build_lake(spark, fewer, snapshot, whole, as_of=day(2))
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name
    assert len(old) == 3 * (4 + 2) and all(os.path.getmtime(f) == t for f, t in old.items())


def test_refused_run_leaves_copies_and_lake(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(1, 4)), snapshot, lake, as_of=day(2))
    copy, = glob.glob(f"{snapshot}/full-*/world")
    before = rows(spark.read.parquet(copy)), rows(open_lake(spark, lake)["fact_covid_country"])
    empty = raw(tmp_path / "in2", range(1, 4), header_only=True)
    with pytest.raises(ValueError, match="world: no rows"):
        build_lake(spark, empty, snapshot, lake, as_of=day(2))
    assert before == (
        rows(spark.read.parquet(copy)), rows(open_lake(spark, lake)["fact_covid_country"]))
    assert len(glob.glob(f"{lake}/versions/*")) == 1 and len(os.listdir(f"{lake}/runs")) == 1


def test_source_without_a_value_stops_the_run(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 4))
    with open(sources.usa) as f:
        text = f.read()
    with open(sources.usa, "w") as f:
        f.write(text.replace('"cases": ', '"cases": "x", "was": '))
    with pytest.raises(ValueError, match="usa: no value in cases"):
        build_lake(spark, sources, str(tmp_path / "s"), str(tmp_path / "lake"), day(2))
    with open(sources.usa, "w") as f:
        f.write(text.replace('"cases"', '"caseload"'))
    with pytest.raises(ValueError, match="lacks the columns .*cases"):
        build_lake(spark, sources, str(tmp_path / "s"), str(tmp_path / "lake"), day(2))


def test_corrected_run_takes_a_revised_day_once(spark, tmp_path):
    """Readings 5, then 10 and 11, then 12."""
    lake, sources = str(tmp_path / "lake"), raw(tmp_path / "in", range(1, 4))
    with open(sources.world, "a") as f:
        for n, cases in ((1, 5), (2, 10), (2, 11), (3, 12)):
            f.write(f"Peru,P,P2,P3,Confirmed,{cases},100,\"P, Peru\",{to_mdy(day(n))},0\n")
    build_lake(spark, sources, str(tmp_path / "s"), lake, day(2), corrected=True)
    peru = open_lake(spark, lake)["fact_covid_country"].where("country_name = 'Peru'")
    assert rows(peru) == [("Peru", day(2), 6, None, 11, None), ("Peru", day(3), 1, None, 12, None)]


def test_month_layout(spark, tmp_path):
    """Fewer files than rows; a reload from the middle of a month equals a full build by day."""
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(20, 40)), snapshot, lake, day(22), layout="month")
    more = raw(tmp_path / "in2", range(20, 45))
    build_lake(spark, more, snapshot, lake, day(22), since=day(41), layout="month")
    whole = str(tmp_path / "whole")
    build_lake(spark, more, snapshot, whole, day(22))
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name
    files = glob.glob(f"{lake}/runs/full*/fact_covid_country/*/month=*/*.parquet")
    assert len(files) == 4 * 2  # four names of countries, two months


def test_layouts_may_change_in_the_middle_of_a_month(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    for i, (last, since, layout) in enumerate(((40, None, "month"), (61, 38, "day"), (70, 62, "month"))):
        sources = raw(tmp_path / f"in{i}", range(20, last))
        build_lake(spark, sources, snapshot, lake, day(22), since=since and day(since), layout=layout)
    whole = str(tmp_path / "whole")
    build_lake(spark, sources, snapshot, whole, day(22))
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name
    assert [len(p) for p in read_version(spark, lake).tables.values()] == [1, 1, 2, 3, 3]
    assert compact_lake(spark, lake, most=3) == []
    assert compact_lake(spark, lake, most=2) == ["fact_covid_country", "fact_covid_country_province"]
    assert [len(p) for p in read_version(spark, lake).tables.values()] == [1, 1, 2, 1, 1]
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == rows(open_lake(spark, whole)[name]), name


@pytest.mark.parametrize("writes", range(6))
def test_run_that_dies_leaves_one_runs_tables(spark, tmp_path, monkeypatch, writes):
    """After any number of the five writes, or in the commit."""
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(1, 4)), snapshot, lake, as_of=day(2))
    opened = open_lake(spark, lake)
    before = {name: rows(df) for name, df in opened.items()}
    left = [writes]

    def dying(*args, **kwargs):
        if not left[0]:
            raise OSError("gone")
        left[0] -= 1
        write_table(*args, **kwargs)

    def no_commit(*args):
        raise OSError("gone")

    more = raw(tmp_path / "in2", range(1, 6))
    with monkeypatch.context() as patch:
        patch.setattr(build, "write_table", dying)
        patch.setattr(build, "ThreadPoolExecutor", lambda n: ThreadPoolExecutor(1))
        if writes == 5:
            patch.setattr(build, "commit", no_commit)
        with pytest.raises(OSError, match="gone"):
            build_lake(spark, more, snapshot, lake, as_of=day(2), since=day(4) if writes % 2 else None)
    for name in schemas.TABLES:
        assert rows(open_lake(spark, lake)[name]) == before[name], name
    build_lake(spark, more, snapshot, lake, as_of=day(2))
    assert rows(opened["fact_covid_country"]) == before["fact_covid_country"]  # a reader of the version before
    assert open_lake(spark, lake)["fact_covid_country"].count() == 5 * 4


def test_versions_roll_back_and_go(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    with pytest.raises(ValueError, match="no version"):
        open_lake(spark, lake)
    build_lake(spark, raw(tmp_path / "in1", range(1, 4)), snapshot, lake, as_of=day(2))
    build_lake(spark, raw(tmp_path / "in2", range(1, 6)), snapshot, lake, as_of=day(2), since=day(4))
    first, second = (rows(open_lake(spark, lake, n)["fact_covid_country"]) for n in (1, 2))
    assert len(first) == 10 and len(second) == 20
    assert roll_back(spark, lake, 1).number == 3
    assert rows(open_lake(spark, lake)["fact_covid_country"]) == first
    with pytest.raises(ValueError, match="no version 9"):
        roll_back(spark, lake, 9)
    build_lake(spark, raw(tmp_path / "in3", range(1, 6)), snapshot, lake, as_of=day(2))
    assert remove_old(spark, lake) == [] and read_version(spark, lake).number == 4
    gone = remove_old(spark, lake, spare=dt.timedelta(0))
    assert [name.split("-")[0] for name in gone] == ["full", "since"]
    assert rows(open_lake(spark, lake)["fact_covid_country"]) == second
    with pytest.raises(ValueError, match="no version 1"):
        open_lake(spark, lake, 1)
    with pytest.raises(ValueError, match="at least one"):
        remove_old(spark, lake, keep=0)


def test_second_of_two_runs_at_a_time_is_refused(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in", range(1, 4)), snapshot, lake, as_of=day(2))
    base = read_version(spark, lake)
    commit(spark, lake, "one", {}, base)
    with pytest.raises(LakeChanged, match="version 2"):
        commit(spark, lake, "two", {}, base)
    (tmp_path / "lake" / "versions" / "3.claim").touch()  # of a run that died while it committed
    assert commit(spark, lake, "three", {}, read_version(spark, lake)).number == 4


def test_counts_from_sketches_only(spark, tmp_path):
    lake, snapshot = str(tmp_path / "lake"), str(tmp_path / "snapshot")
    build_lake(spark, raw(tmp_path / "in1", range(1, 6)), snapshot, lake, as_of=day(2))
    assert len(sketch_lake(spark, lake)) == 5 and sketch_lake(spark, lake) == []
    build_lake(spark, raw(tmp_path / "in2", range(1, 9)), snapshot, lake, as_of=day(2), since=day(6))
    assert len(sketch_lake(spark, lake)) == 5

    def counts(**options):
        found = sketched_counts(spark, lake, **options)
        assert found.inputFiles() and all("/sketches/" in f for f in found.inputFiles())
        return {(r["table_name"], r["column_name"]): r["estimate"] for r in found.collect()}

    fact, provinces = "fact_covid_country", "fact_covid_country_province"
    now = counts()
    assert now[fact, "dates"] == 7 and now[fact, "countries"] == 3 and now[provinces, "provinces"] == 2 and now["dim_time", "dates"] == 8
    assert now["dim_country", "countries"] == 3 and now["dim_province", "provinces"] == 2
    assert counts(version=2)[fact, "dates"] == 4
    assert counts(since=day(3), until=day(6))[fact, "dates"] == 4


def test_corrected_run_over_gaps_and_falls(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 4))
    with open(sources.world, "a") as f:
        for n, cases in ((1, 5), (2, 9), (5, 21), (6, 18)):
            f.write(f"Peru,P,P2,P3,Confirmed,{cases},100,\"P, Peru\",{to_mdy(day(n))},0\n")
    found = {}
    for kind in ("lag", "spread", "risen"):
        lake = str(tmp_path / kind)
        build_lake(spark, sources, str(tmp_path / "s"), lake, day(2), corrected=True, increments=kind)
        fact = open_lake(spark, lake)["fact_covid_country"]
        found[kind] = rows(fact.where("country_name = 'Peru'"), "date", "confirmed_cases", "sum_confirmed_cases")
        assert (kind == "lag") != (fact.where("country_name = 'Brazil'").count() == 3)
    assert found["lag"] == [(day(2), 4, 9), (day(6), -3, 18)]
    assert found["spread"] == [(day(1), 5, 5), (day(2), 4, 9), (day(3), 4, 13), (day(4), 4, 17), (day(5), 4, 21), (day(6), -3, 18)]
    assert found["risen"] == [(day(1), 5, 5), (day(2), 4, 9), (day(5), 4, 13), (day(6), 5, 18)]
    with pytest.raises(ValueError, match="all days"):
        build_lake(spark, sources, str(tmp_path / "s"), lake, day(2), increments="spread")
