"""Daily increments of cumulative counts.

An increment exists for a row when the same key also has a row on the day before. Null keys
and null dates never match anything, so they are filtered before the shuffle: left in, all of
them would meet in one window partition.

Choosing a form:

* ``daily_delta(how="lag")`` -- one shuffle by key. Needs one row per key and day, which also
  bounds a window partition to the days of one place. ``sources.repeated_days`` tells.
* ``daily_delta(how="range")`` -- as ``lag``, with a one-day range frame.
* ``daily_delta(how="join")`` -- right for any input: every row meets every row of the day
  before. It shuffles by key *and* date, so a large place is spread over its days.
* ``distinct_delta`` -- the distinct increments, for any input, in the cheapest form known to
  be right for it.
* ``pair_totals`` -- the sums over those pairs, likewise, without making the pairs.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from .gaps import risen_delta, spread_delta

# The name of a form, or the keys to treat apart (see distinct_delta).
Form = str | DataFrame
# Forms that give other increments than readings of neighbouring days do.
OTHER = {
    "spread": lambda df, keys, date, measures: spread_delta(df, keys, date, measures).drop("gap"),
    "risen": risen_delta,
}


def _delta(m: str) -> str:
    return f"{m}_delta"


def _matchable(df: DataFrame, keys: list[str], date: str, measures: list[str]) -> DataFrame:
    # The last term changes nothing, but a join on the next day implies it for one side only;
    # stated for both, they stay the same plan and Spark computes what lies below once.
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, date]])
    known = known & F.date_add(date, 1).isNotNull()
    return df.select(*keys, date, *measures).where(known)


def daily_delta(
    df: DataFrame, keys: list[str], date: str, measures: list[str], how: str = "join"
) -> DataFrame:
    """Columns ``keys, date``, each measure ``m``, and ``m_delta`` = m minus m one day earlier."""
    rows = _matchable(df, keys, date, measures)
    before = {m: f"_before_{m}" for m in measures}
    if how == "join":
        earlier = rows.select(
            *keys,
            F.date_add(date, 1).alias(date),
            *[F.col(m).alias(before[m]) for m in measures],
        )
        paired = rows.join(earlier, [*keys, date])
    elif how == "lag":
        w = Window.partitionBy(*keys).orderBy(date)
        paired = rows.select(
            "*",
            F.lag(date).over(w).alias("_day_before"),
            *[F.lag(m).over(w).alias(before[m]) for m in measures],
        ).where(F.col("_day_before") == F.date_sub(date, 1))
    elif how == "range":
        w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(-1, -1)
        paired = rows.select(
            "*",
            F.count("*").over(w).alias("_rows_before"),
            *[F.max(m).over(w).alias(before[m]) for m in measures],
        ).where(F.col("_rows_before") > 0)
    else:
        raise ValueError(f"how must be 'join', 'lag' or 'range', not {how!r}")
    return paired.select(
        *keys,
        date,
        *[(F.col(m) - F.col(before[m])).alias(_delta(m)) for m in measures],
        *measures,
    )


def _apart(rows: DataFrame, keys: list[str], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all other places, and those of the places in ``repeated``; by its size Spark
    broadcasts that table or shuffles."""
    named = repeated.select(*keys)
    return rows.join(named, keys, "left_anti"), rows.join(named, keys, "left_semi")


def distinct_delta(
    df: DataFrame, keys: list[str], date: str, measures: list[str], how: Form = "join"
) -> DataFrame:
    """What ``daily_delta(how="join")`` gives, with equal rows merged where they would multiply
    (a caller that needs all of them distinct says so after its own projection).

    ``how`` is ``"lag"`` for one row per key and day, ``"join"`` for any input, or a table of
    the keys that have repeated days, as ``sources.choose_form`` finds them: those are joined
    and all other places go through the lag form. ``"spread"`` and ``"risen"`` give other increments, those of
    ``spread_delta`` and ``risen_delta``, and need one row per key and day.
    """
    rows = df.select(*keys, date, *measures)
    if how in OTHER:
        return OTHER[how](rows, keys, date, measures)
    if isinstance(how, DataFrame):
        steady, others = _apart(rows, keys, how)
        return distinct_delta(steady, keys, date, measures, "lag").unionByName(
            distinct_delta(others, keys, date, measures, "join")
        )
    if how == "lag":
        return daily_delta(rows, keys, date, measures, how)
    if how != "join":
        raise ValueError(f"how must be 'join', 'lag' or a table of keys, not {how!r}")
    # Equal readings of a day give equal rows, times those of the day before.
    return daily_delta(rows.distinct(), keys, date, measures, how)


def pair_totals(
    df: DataFrame, keys: list[str], date: str, measures: list[str], how: Form = "join"
) -> DataFrame:
    """Per key and day, the sums of ``m_delta`` and ``m`` over all pairs ``daily_delta`` would make.

    With n rows on a day and p rows on the day before there are n*p pairs, yet their sums need
    only the row counts and sums of both days: sum(c - b) = p*sum(c) - n*sum(b), counting for
    the difference only rows that have a value, and sum(c) = p*sum(c). Each row is therefore
    marked once for its own day and once for the next, and one grouping by key and day does
    the rest. Copies and repeated days collapse before the shuffle, and a large place is
    spread over its days.

    ``how`` is as for ``distinct_delta``: where a key has one row a day there is one pair at
    most, and the lag form already gives the sums.
    """
    if isinstance(how, DataFrame):
        steady, others = _apart(df.select(*keys, date, *measures), keys, how)
        return pair_totals(steady, keys, date, measures, "lag").unionByName(
            pair_totals(others, keys, date, measures, "join")
        )
    if how in OTHER:
        return OTHER[how](df, keys, date, measures)
    if how == "lag":
        return daily_delta(df, keys, date, measures, how)
    if how != "join":
        raise ValueError(f"how must be 'join', 'lag' or a table of keys, not {how!r}")
    rows = _matchable(df, keys, date, measures)
    own, following = "_own", "_following"
    marked = rows.select(
        *keys,
        *measures,
        F.inline(
            F.array(
                F.struct(F.lit(True).alias(own), F.col(date).alias(following)),
                F.struct(F.lit(False).alias(own), F.date_add(date, 1).alias(following)),
            )
        ),
    ).withColumnRenamed(following, date)
    today, before = F.col(own), ~F.col(own)
    sides = []
    for m in measures:
        for name, side in (("now", today), ("was", before)):
            value = F.when(side, F.col(m))
            sides += [F.sum(value).alias(f"{m}_{name}"), F.count(value).alias(f"{m}_n_{name}")]
    days = (
        marked.groupBy(*keys, date)
        .agg(F.count_if(today).alias("_n"), F.count_if(before).alias("_p"), *sides)
        .where((F.col("_n") > 0) & (F.col("_p") > 0))
    )
    return days.select(
        *keys,
        date,
        *[
            (
                F.col(f"{m}_now") * F.col(f"{m}_n_was") - F.col(f"{m}_was") * F.col(f"{m}_n_now")
            ).alias(_delta(m))
            for m in measures
        ],
        *[(F.col(f"{m}_now") * F.col("_p")).alias(m) for m in measures],
    )
