"""A table of increments that grows by loads of new days, at the price of those days.

Kept as versions of a lake (see ``sinks.versions``), four tables:

* ``readings``: the rows of each load, in a part of its own.
* ``increments``: what each load computed, likewise. Rows carry the number of their ``load``.
* ``state``: the last reading of each key, written anew by every load.
* ``redone``: keys that a load computed anew, with its number; rows of earlier loads no longer
  count for them.

A load reads its new rows and the state. Only where rows come late does it read ``readings``, and
then for the keys concerned; a revised reading of a day replaces the one before. N loads thus give what
one load of all rows gives.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import carried_delta, daily_delta, late_keys, next_state
from ..sinks import Part, commit, read_parts, read_version, run_path

LOAD = "load"


def _delta_schema(schema: T.StructType, keys: list[str], date: str, measures: list[str]) -> T.StructType:
    deltas = [T.StructField(f"{m}_delta", schema[m].dataType) for m in measures]
    return T.StructType([*(schema[c] for c in (*keys, date)), *deltas, *(schema[m] for m in measures)])


def _with_load(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(LOAD, T.IntegerType())])


class DailyIncrements:
    """Increments of ``measures`` by ``keys`` and day, kept at ``path``.

    ``rows`` names the columns' types. A load has one row per key and day; a later load may bring a day of
    a key again, which replaces its reading.
    """

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, keys: list[str], date: str, measures: list[str]):
        self.spark, self.path, self.keys, self.date, self.measures = spark, path.rstrip("/"), keys, date, measures
        self.rows = T.StructType([T.StructField(c, rows[c].dataType) for c in (*keys, date, *measures)])
        self.schemas = {
            "readings": _with_load(self.rows),
            "increments": _with_load(_delta_schema(self.rows, keys, date, measures)),
            "state": self.rows,
            "redone": _with_load(T.StructType([self.rows[c] for c in keys])),
        }

    def _table(self, name: str, version) -> DataFrame:
        schema = self.schemas[name]
        if version is None or name not in version.tables:
            return self.spark.createDataFrame([], schema)
        return read_parts(self.spark, self.path, version.tables[name], schema)

    def _write(self, df: DataFrame, name: str, run: str) -> DataFrame:
        """Written and read again, so that no later step computes it once more."""
        schema, path = self.schemas[name], f"{self.path}/{run_path(run, name)}"
        df.select(*schema.names).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def load(self, new: DataFrame) -> int:
        """Add the rows of ``new``; returns the number of the load."""
        base = read_version(self.spark, self.path)
        number = base.number + 1 if base else 1
        run = f"load{number}-{uuid.uuid4().hex[:8]}"
        shape = (self.keys, self.date, self.measures)
        known = new.select(*self.rows.names).dropna(subset=[*self.keys, self.date])
        new = self._write(known.withColumn(LOAD, F.lit(number)), "readings", run).drop(LOAD)
        state = self._table("state", base)
        late = late_keys(new, state, self.keys, self.date).withColumn(LOAD, F.lit(number))
        late = self._write(late, "redone", run)
        some = not late.isEmpty()
        steady = new.join(late, self.keys, "left_anti") if some else new
        found = carried_delta(steady, state, *shape)
        after = next_state(steady, state, *shape)
        if some:
            earlier = self._latest(self._table("readings", base).join(late.select(*self.keys), self.keys, "left_semi"), new, late)
            found = found.unionByName(daily_delta(earlier, *shape, "lag"))
            after = next_state(earlier, after.join(late, self.keys, "left_anti"), *shape)
        self._write(found.withColumn(LOAD, F.lit(number)), "increments", run)
        self._write(after, "state", run)
        parts = {name: Part(run_path(run, name)) for name in self.schemas}
        added = ["readings", "increments", *(["redone"] if some else [])]
        if not some:
            parts.pop("redone")
        commit(self.spark, self.path, run, parts, base, added)
        return number

    def _latest(self, earlier: DataFrame, new: DataFrame, late: DataFrame) -> DataFrame:
        """All readings of the late keys, of each day the one that came last."""
        own = new.join(late.select(*self.keys), self.keys, "left_semi").withColumn(LOAD, F.lit(2 ** 31 - 1))
        rows = earlier.unionByName(own)
        last = F.max_by(F.struct(*self.measures), LOAD).alias("_last")
        return rows.groupBy(*self.keys, self.date).agg(last).select(*self.keys, self.date, "_last.*")

    def increments(self, number: int | None = None) -> DataFrame:
        """Columns as of ``daily_delta``, after all loads or after load ``number``."""
        version = read_version(self.spark, self.path, number)
        rows = self._table("increments", version)
        if version and "redone" in version.tables:
            since = self._table("redone", version).groupBy(*self.keys).agg(F.max(LOAD).alias("_since"))
            rows = rows.join(since, self.keys, "left").where(F.col(LOAD) >= F.coalesce("_since", F.lit(0)))
        return rows.select(*[c for c in self.schemas["increments"].names if c != LOAD])
