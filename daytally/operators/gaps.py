"""Increments of series with missing days, and of series that fall.

``spread_delta`` gives every day from a key's first reading to its last an increment: a day without
reading lies in a gap, and the change over a gap is spread over its days in whole numbers that add up
to it. ``risen_delta`` takes back what was counted too much: increments below zero are pooled with the
days before until none is left, and the total of a key stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _share(total: Column, i: Column, n: Column) -> Column:
    """What of ``total`` has been reached after ``i`` of ``n`` equal steps, as a whole number."""
    return F.floor(total * i / n)


def spread_delta(
    df: DataFrame, keys: list[str], date: str, measures: list[str], first: bool = True
) -> DataFrame:
    """Columns ``keys, date``, each measure ``m`` and ``m_delta``, and ``gap``, the number of days that the
    reading stands for (1 without a gap).

    Needs one row per key and day. On the i-th of a gap's n days a measure has risen by floor(change * i / n).
    A key's first day has its reading as increment, counting from 0 before it, or no row if not
    ``first``. A null reading leaves the increments up to it and from it null. One shuffle by key; what
    grows a row to the days of its gap stays in the same stage.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    rows = df.select(*keys, date, *measures).dropna(subset=[*keys, date]).select(
        "*", F.lag(date).over(w).alias("_before"),
        *[F.lag(m).over(w).alias(f"_before_{m}") for m in measures])
    begins = F.col("_before").isNull()
    if not first:
        rows = rows.where(~begins)
    gap = F.when(begins, 1).otherwise(F.date_diff(date, "_before"))
    days = rows.withColumn("gap", gap).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("gap"))))
    columns = []
    for m in measures:
        was = F.when(begins, F.lit(0)).otherwise(F.col(f"_before_{m}"))
        change, n, i = F.col(m) - was, F.col("gap"), F.col("_i")
        reached = _share(change, i, n)
        columns += [(was + reached).cast("bigint").alias(m), (reached - _share(change, i - 1, n)).cast("bigint").alias(f"{m}_delta")]
    day = F.date_add(F.date_sub(date, F.col("gap")), F.col("_i")).alias(date)
    return days.select(*keys, day, "gap", *columns)


def _pooled(increments: Column) -> Column:
    """An array of (sum, days): adjacent increments pooled from left to right as long as the last sum is
    below zero and there is one before, or the first one is."""
    block = "array<struct<sum:bigint,days:int>>"

    def merge(blocks: Column) -> Column:
        last, before = F.element_at(blocks, -1), F.element_at(blocks, -2)
        one = F.struct((last["sum"] + before["sum"]).alias("sum"), (last["days"] + before["days"]).alias("days"))
        return F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 2), F.array(one))

    def push(blocks: Column, x: Column) -> Column:
        more = F.concat(blocks, F.array(F.struct(x.cast("bigint").alias("sum"), F.lit(1).alias("days"))))
        # A new block can only pull in as many before it as there are.
        def settle(state: Column, _: Column) -> Column:
            due = (F.size(state) > 1) & ((F.element_at(state, -1)["sum"] < 0) | (F.element_at(state, -2)["sum"] < 0))
            return F.when(due, merge(state)).otherwise(state)

        due = (x < 0) | ((F.size(blocks) > 0) & (F.element_at(blocks, -1)["sum"] < 0))
        return F.when(due, F.aggregate(F.sequence(F.lit(1), F.size(more)), more, settle)).otherwise(more)

    return F.aggregate(increments, F.array().cast(block), push)


def risen_delta(df: DataFrame, keys: list[str], date: str, measures: list[str]) -> DataFrame:
    """Columns ``keys, date``, each measure ``m`` and ``m_delta`` for each row of ``df`` with a reading, no
    increment below zero unless the total of its key is.

    Needs one row per key and day; the first increment is the first reading. Increments are pooled as by
    pool-adjacent-violators: a negative one joins the days before until their sum is not below zero, and
    each pool is spread over its days in whole numbers. The last reading of a key stays what it was. A day
    whose reading is null has no increment of that measure, and none of any if all are null.
    A key's days are brought into one row, which holds a date and a number for each and measure.
    """
    rows = df.select(*keys, date, *measures).dropna(subset=[*keys, date]).dropna(how="all", subset=measures)

    def days(m: str) -> Column:
        known = F.when(F.col(m).isNotNull(), F.struct(F.col(date).alias("d"), F.col(m).alias("v")))
        return F.array_sort(F.collect_list(known)).alias(m)

    def placed(m: str) -> Column:
        values = F.transform(m, lambda x: x["v"])
        increments = F.transform(values, lambda v, i: v - F.when(i > 0, F.get(values, i - 1)).otherwise(0))
        spread = F.flatten(F.transform(_pooled(increments), lambda b: F.transform(
            F.sequence(F.lit(1), b["days"]),
            lambda i: (_share(b["sum"], i, b["days"]) - _share(b["sum"], i - 1, b["days"])).cast("bigint"))))
        pairs = F.arrays_zip(F.transform(m, lambda x: x["d"]).alias("d"), spread.alias("delta"))
        return F.transform(pairs, lambda x: F.struct(F.lit(m).alias("m"), x["d"].alias("d"), x["delta"].alias("delta")))

    series = rows.groupBy(*keys).agg(*[days(m) for m in measures])
    each = series.select(*keys, F.explode(F.concat(*[placed(m) for m in measures])).alias("x"))
    wide = each.groupBy(*keys, F.col("x.d").alias(date)).agg(
        *[F.max(F.when(F.col("x.m") == m, F.col("x.delta"))).alias(f"{m}_delta") for m in measures])
    so_far = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    totals = [F.when(F.col(f"{m}_delta").isNotNull(), F.sum(f"{m}_delta").over(so_far)).alias(m) for m in measures]
    return wide.select(*keys, date, *[f"{m}_delta" for m in measures], *totals)
