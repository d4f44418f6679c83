"""A whole run: land the sources, check them, build and write the star schema, report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import union_tables
from ..schemas import ALIASES, BRAZIL_NAME, LAYOUTS, TABLES
from ..sinks import Part, commit, read_parts, read_version, run_path, with_month, write_table
from ..sources import choose_form, input_check, land, land_checked, read_csv, read_json
from . import dims, facts, quality


@dataclass(frozen=True)
class Sources:
    """Paths of the four inputs."""

    world: str
    brazil: str
    provinces: str
    usa: str


def _first_fact_day(since: dt.date) -> dt.date:
    """The day before ``since``: its counts are what the first increments start from."""
    return since - dt.timedelta(days=1)


def _first_landed_day(since: dt.date) -> dt.date:
    """The start of that day's month, so that the time dimension's folders are whole."""
    return _first_fact_day(since).replace(day=1)


def _raw(spark: SparkSession, sources: Sources, since: dt.date | None, as_of: dt.date) -> dict[str, DataFrame]:
    """The inputs as they are read, each once.

    With ``since``, only the rows a load from that day on needs are kept, before the shuffle
    that drops repeated rows: the days concerned and the day of the population figures.
    """
    world = facts.with_day(read_csv(spark, sources.world, schemas.WORLD))
    brazil = read_csv(spark, sources.brazil, schemas.BRAZIL)
    usa = read_json(spark, sources.usa, schemas.USA)
    if since is not None:
        first = F.lit(_first_landed_day(since))
        world = world.where((F.col("day") >= first) | (F.col("day") == F.lit(as_of)))
        brazil = brazil.where((F.col("date") >= first) | (F.col("date") == F.lit(as_of)))
        usa = usa.where(F.col("date") >= first)
    provinces = read_csv(spark, sources.provinces, schemas.PROVINCES)
    return {"world": world, "brazil": brazil, "provinces": provinces, "usa": usa}


def land_sources(
    spark: SparkSession,
    sources: Sources,
    snapshot: str,
    since: dt.date | None = None,
    as_of: dt.date = dims.POPULATION_DAY,
) -> dict[str, DataFrame]:
    """Typed copies of the inputs, without repeated rows, under ``snapshot``."""
    raw = _raw(spark, sources, since, as_of)
    return {name: land(df, f"{snapshot.rstrip('/')}/{name}") for name, df in raw.items()}


# What must not be null for a row to count: a date or number that could not be read is null.
NEEDED = {
    "world": [*facts.WORLD_KEYS, "day", "cases"],
    "brazil": [*facts.BRAZIL_KEYS, "date", *facts.BRAZIL_COUNTS],
    "provinces": schemas.PROVINCES.names,
    "usa": [*facts.USA_KEYS, "date", *facts.USA_COUNTS],
}


def _together(work: Callable, names: Iterable[str]) -> dict:
    """What ``work`` gives for each name. Independent jobs run at the same time, so that each fills what
    the others leave idle."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        return dict(zip(names, pool.map(work, names)))


def _by_source(reports: dict[str, DataFrame]) -> DataFrame:
    named = [report.withColumn("source", F.lit(name)) for name, report in reports.items()]
    return union_tables(*named).select("source", "check_name", "found", "passed")


def check_inputs(inputs: dict[str, DataFrame]) -> DataFrame:
    """The checks of all inputs in one table, in one pass over the columns needed."""
    return _by_source({name: input_check(df, NEEDED[name], NEEDED[name]) for name, df in inputs.items()})


def land_and_check(
    spark: SparkSession,
    sources: Sources,
    snapshot: str,
    since: dt.date | None = None,
    as_of: dt.date = dims.POPULATION_DAY,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The copies of ``land_sources`` and their ``check_inputs``, counted while they are written."""
    raw = _raw(spark, sources, since, as_of)
    done = _together(
        lambda name: land_checked(raw[name], f"{snapshot.rstrip('/')}/{name}", NEEDED[name], NEEDED[name]), raw)
    return (
        {name: copy for name, (copy, _) in done.items()},
        _by_source({name: report() for name, (_, report) in done.items()}),
    )


def increment_forms(inputs: dict[str, DataFrame], snapshot: str) -> facts.Forms:
    """The increment form for each source, from the repeated days it has."""
    series = {
        "world": (facts.world_days(inputs["world"]), facts.WORLD_KEYS, "day"),
        "brazil": (facts.brazil_states(inputs["brazil"]), facts.BRAZIL_KEYS, "date"),
        "usa": (inputs["usa"], facts.USA_KEYS, "date"),
    }
    return _together(
        lambda name: choose_form(*series[name], f"{snapshot.rstrip('/')}/repeated_{name}"), series)


def lost_inputs(checks: DataFrame) -> list[str]:
    """What no run can do without: sources without rows, and needed columns that are wholly null.

    ``checks`` is the table ``check_inputs`` makes, a few rows for each source.
    """
    found = checks.collect()
    rows = {row.source: row.found for row in found if row.check_name == "rows"}
    lost = [f"{source}: no rows" for source, n in rows.items() if not n]
    return lost + sorted(
        f"{row.source}: no value in {row.check_name.removeprefix('nulls:')}"
        for row in found
        if row.check_name.startswith("nulls:") and row.found == rows[row.source] > 0
    )


def _from_day(inputs: dict[str, DataFrame], first: dt.date) -> dict[str, DataFrame]:
    return {
        "world": facts.with_day(inputs["world"]).where(F.col("day") >= F.lit(first)),
        "brazil": inputs["brazil"].where(F.col("date") >= F.lit(first)),
        "usa": inputs["usa"].where(F.col("date") >= F.lit(first)),
    }


def build_tables(
    inputs: dict[str, DataFrame],
    as_of: dt.date = dims.POPULATION_DAY,
    since: dt.date | None = None,
    forms: facts.Forms = facts.ANY_SOURCE,
    corrected: bool = False,
    increments: str = "lag",
) -> dict[str, DataFrame]:
    """The five tables. ``since`` limits the facts to days from then on, and the time dimension
    to whole months that cover them.

    ``corrected=True`` counts every place once a day, with the largest of its readings, and takes
    the detailed countries from their own sources only; the default gives what existing tables hold.
    Its ``increments`` may also be ``"spread"`` or ``"risen"`` (see ``facts.one_reading_forms``); these
    need all days of a place, so they go without ``since``.
    """
    if increments != "lag" and (since is not None or not corrected):
        raise ValueError(f"{increments!r} increments need a corrected run over all days")
    world, brazil, provinces = inputs["world"], inputs["brazil"], inputs["provinces"]
    late, times = inputs, world
    if since is not None:
        late = _from_day(inputs, _first_fact_day(since))
        times = _from_day(inputs, _first_landed_day(since))["world"]
    if corrected:
        late = facts.one_reading(late["world"], late["brazil"], late["usa"])
        forms = facts.one_reading_forms(increments)
    world_options = {"places": "each", "no_confirmed": facts.DETAILED} if corrected else {}
    return {
        "dim_country": dims.dim_country(world, as_of),
        "dim_province": dims.dim_province(
            world, brazil, provinces, as_of, usa_population="sum" if corrected else "max"
        ),
        "dim_time": dims.dim_time(times, None if corrected else BRAZIL_NAME),
        "fact_covid_country": facts.country_fact(
            late["world"], late["brazil"], late["usa"], forms, **world_options
        ),
        "fact_covid_country_province": facts.province_fact(
            late["brazil"], provinces, late["usa"], forms
        ),
    }


def _parts(run: str, layout: str = "day", since: dt.date | None = None) -> dict[str, Part]:
    """What a run adds to each table."""
    month = "month" if layout == "month" else None
    times = None if since is None else _first_landed_day(since)
    return {
        table: Part(run_path(run, table), "date", since, month=month) if table.startswith("fact_")
        else Part(run_path(run, table), "date_key", times) if table == "dim_time"
        else Part(run_path(run, table))
        for table in TABLES
    }


def _write_part(df: DataFrame, lake: str, part: Part, folders: list[str]) -> None:
    """A fact by day has a folder for each place and day, of a row or two: by size all of them would go to one
    task, so they are dealt out to as many tasks as the session shuffles with."""
    path = f"{lake}/{part.path}"
    if part.month:
        write_table(with_month(df), path, folders)
    elif "date" in folders:
        write_table(df, path, folders, tasks=int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    else:
        write_table(df, path, folders)


def _run_name(kind: str) -> str:
    now = dt.datetime.now(dt.timezone.utc)
    return f"{kind}-{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def build_lake(
    spark: SparkSession,
    sources: Sources,
    snapshot: str,
    lake: str,
    as_of: dt.date = dims.POPULATION_DAY,
    since: dt.date | None = None,
    corrected: bool = False,
    layout: str = "day",
    increments: str = "lag",
) -> DataFrame:
    """Run everything and return the quality report of the written tables.

    Both paths must be reachable by all executors. Running it again leaves one copy of every
    row. Each run lands its copies and ``checks``, the report on them, in a folder of its own below
    ``snapshot``, so earlier copies stay. A source without rows, or with nothing in a column that
    is needed, stops the run before the lake is touched. The tables are written to folders of the run
    and become a version of the lake together (see ``sinks.versions``); a run that breaks off leaves the
    lake as it was.

    With ``since``, days before stay as they are, those from then on become what a full run would
    make of them, and the work is that of the later days (a source that is one full file is still
    read whole).

    ``layout="month"`` keeps the facts in a folder per country and month instead of one per place and
    day; with ``since`` the whole of its month is then loaded again. Each run may choose its layout.
    """
    lake, folders = lake.rstrip("/"), LAYOUTS[layout]
    if increments != "lag" and (since is not None or not corrected):
        raise ValueError(f"{increments!r} increments need a corrected run over all days")
    if since is not None and layout == "month":
        since = since.replace(day=1)
    name = _run_name("full" if since is None else f"since-{since}")
    run, base = f"{snapshot.rstrip('/')}/{name}", read_version(spark, lake)
    inputs, checks = land_and_check(spark, sources, run, since, as_of)
    checks.write.parquet(f"{run}/checks")
    lost = lost_inputs(spark.read.parquet(f"{run}/checks"))
    if lost:
        raise ValueError(f"{'; '.join(lost)} (see {run}/checks)")
    forms = facts.ONE_READING if corrected else increment_forms(inputs, run)
    tables = build_tables(inputs, as_of, since, forms, corrected, increments)
    parts = _parts(name, layout, since)
    _together(lambda table: _write_part(tables[table], lake, parts[table], folders[table]), tables)
    commit(spark, lake, name, parts, base)
    return lake_quality(spark, lake, inputs if since is None else None)


def open_lake(
    spark: SparkSession, lake: str, version: int | None = None
) -> dict[str, DataFrame]:
    """The tables of one version, by default the latest. They stay those of that version while
    later runs commit."""
    lake = lake.rstrip("/")
    found = read_version(spark, lake, version)
    if found is None:
        raise ValueError(f"{lake} holds no version of a lake")
    return {
        name: read_parts(spark, lake, found.tables[name], schema) for name, schema in TABLES.items()
    }


def compact_lake(spark: SparkSession, lake: str, most: int = 31, layout: str = "day") -> list[str]:
    """Write each table that has more than ``most`` parts anew as one, and commit that; returns the
    tables' names. Loads from a day on add a part each, and every part is a scan of its own."""
    lake = lake.rstrip("/")
    base = read_version(spark, lake)
    many = [name for name, parts in base.tables.items() if len(parts) > most] if base else []
    if many:
        name = _run_name("compacted")
        parts, tables = _parts(name, layout), open_lake(spark, lake, base.number)
        for table in many:
            _write_part(tables[table], lake, parts[table], LAYOUTS[layout][table])
        commit(spark, lake, name, {table: parts[table] for table in many}, base)
    return many


def lake_quality(
    spark: SparkSession, lake: str, sources: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The report on the latest version; with the landed ``sources`` of a full run, on what has
    arrived of them too."""
    return quality.whole_report(open_lake(spark, lake), sources, ALIASES)
