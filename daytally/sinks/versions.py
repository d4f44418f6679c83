"""Versions of a lake: runs in folders of their own, and a log that tells which of them count.

    <lake>/runs/<run>/<table>/...     what one run wrote; never changed afterwards
    <lake>/versions/<number>.json     what each table consists of from that commit on

A run writes its tables and then publishes all of them by one rename of one small file, so that a
reader sees the tables of one commit, whatever a run is doing or where it died. A table is one or more
parts, each a folder of a run with the days it stands for: a load from a day on ends the parts before at
that day and adds its own, so days before stay where they are and nothing is listed, moved or deleted.

Two runs that commit at a time: the one that finds the lake changed since it began is refused.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import union_tables
from .lake import drop_table, hadoop


@dataclass(frozen=True)
class Part:
    """A folder below the lake, and the days of it that count: from ``since`` to the day before
    ``until``, by the date column ``column``. Rows without date belong to a part without ``since``.
    ``month`` names a folder column that holds the first day of the date's month, if there is one."""

    path: str
    column: str | None = None
    since: dt.date | None = None
    until: dt.date | None = None
    month: str | None = None

    def before(self, day: dt.date) -> Part | None:
        """What is left of this part when another takes over at ``day``."""
        if self.since is not None and self.since >= day:
            return None
        return replace(self, until=min(day, self.until or day))


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    made: str
    tables: dict[str, list[Part]]


class LakeChanged(RuntimeError):
    """Another run has committed since this one began."""


def run_path(run: str, table: str) -> str:
    return f"runs/{run}/{table}"


def _numbers(spark: SparkSession, lake: str) -> tuple[list[int], int]:
    """The committed versions, and the highest number that anyone has claimed."""
    fs, place = hadoop(spark, f"{lake}/versions")
    names = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
    done = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")
    claimed = [int(n.removesuffix(".claim")) for n in names if n.endswith(".claim")]
    return done, max([0, *done, *claimed])


def read_version(spark: SparkSession, lake: str, number: int | None = None) -> Version | None:
    """A version, by default the latest; None for a lake without any."""
    done, _ = _numbers(spark, lake)
    if number is None:
        if not done:
            return None
        number = done[-1]
    elif number not in done:
        raise ValueError(f"{lake} has no version {number}, only {done}")
    fs, place = hadoop(spark, f"{lake}/versions/{number}.json")
    stream = fs.open(place)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()

    def day(text: str | None) -> dt.date | None:
        return text and dt.date.fromisoformat(text)

    tables = {
        name: [replace(Part(**p), since=day(p["since"]), until=day(p["until"])) for p in parts]
        for name, parts in found["tables"].items()
    }
    return Version(number, found["run"], found["made"], tables)


def commit(
    spark: SparkSession, lake: str, run: str, parts: dict[str, Part], base: Version | None,
    added: Iterable[str] = (),
) -> Version:
    """Publish ``parts``, one for each table that ``run`` wrote, as the version after ``base``.

    The parts of the tables ``added`` come beside those before. Of the others, a part with ``since``
    takes over from that day on, and any other replaces its table. Tables that are not named stay
    as they are in ``base``.
    """
    tables, added = dict(base.tables) if base else {}, set(added)
    for name, part in parts.items():
        earlier = tables.get(name, []) if part.since is not None or name in added else []
        kept = earlier if name in added else [p.before(part.since) for p in earlier]
        tables[name] = [*(p for p in kept if p), part]
    return _publish(spark, lake, run, tables, base)


def _publish(
    spark: SparkSession, lake: str, run: str, tables: dict[str, list[Part]], base: Version | None
) -> Version:
    done, highest = _numbers(spark, lake)
    if (done[-1] if done else None) != (base.number if base else None):
        raise LakeChanged(f"{lake} is at version {done[-1] if done else None} by now")
    number = highest + 1
    fs, claim = hadoop(spark, f"{lake}/versions/{number}.claim")
    try:
        fs.create(claim, False).close()
    except Exception as error:
        raise LakeChanged(f"{lake}: version {number} is being made by another run") from error
    version = Version(number, run, dt.datetime.now(dt.timezone.utc).isoformat(), tables)
    record = {"run": run, "made": version.made, "tables": {n: [asdict(p) for p in ps] for n, ps in tables.items()}}
    _, draft = hadoop(spark, f"{lake}/versions/.{number}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(record, default=str, indent=1).encode()))
    finally:
        out.close()
    _, target = hadoop(spark, f"{lake}/versions/{number}.json")
    if not fs.rename(draft, target):
        raise OSError(f"cannot publish {target}")
    fs.delete(claim, False)
    return version


def roll_back(spark: SparkSession, lake: str, number: int) -> Version:
    """Make a new version that holds what version ``number`` held."""
    old = read_version(spark, lake, number)
    return _publish(spark, lake, old.run, old.tables, read_version(spark, lake))


def read_parts(
    spark: SparkSession, lake: str, parts: Iterable[Part], schema: T.StructType
) -> DataFrame:
    """A table of a version with its declared types; filters reach the folders of each part."""
    return union_tables(*[_read_part(spark, f"{lake}/{part.path}", part, schema) for part in parts])


def _read_part(spark: SparkSession, path: str, part: Part, schema: T.StructType) -> DataFrame:
    own = T.StructType([*schema, T.StructField(part.month, T.DateType())]) if part.month else schema
    rows = spark.read.schema(own).parquet(path)
    for column in filter(None, (part.column, part.month)):
        if part.until is not None:
            early = F.col(column) < F.lit(part.until)
            rows = rows.where(early if part.since else early | F.col(column).isNull())
        if part.since is not None:
            first = part.since.replace(day=1) if column == part.month else part.since
            rows = rows.where(F.col(column) >= F.lit(first))
    return rows.select(*schema.names)


def remove_old(spark: SparkSession, lake: str, keep: int = 1, spare: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete all versions but the last ``keep`` and the runs that none of those needs; returns the
    runs. A run of the last ``spare`` is left alone: it may not have committed yet, or a reader may
    still be at it."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    done, _ = _numbers(spark, lake)
    kept = [read_version(spark, lake, n) for n in done[-keep:]]
    needed = {p.path.split("/")[1] for v in kept for ps in v.tables.values() for p in ps}
    for number in done[:-keep]:
        drop_table(spark, f"{lake}/versions/{number}.json")
    fs, place = hadoop(spark, f"{lake}/runs")
    latest = (dt.datetime.now(dt.timezone.utc) - spare).timestamp() * 1000
    gone = [
        f.getPath().getName() for f in (fs.listStatus(place) if fs.exists(place) else [])
        if f.getPath().getName() not in needed and f.getModificationTime() <= latest
    ]
    for run in gone:
        drop_table(spark, f"{lake}/runs/{run}")
    return sorted(gone)
