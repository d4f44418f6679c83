"""Inner join to a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_lookup(
    df: DataFrame, lookup: DataFrame, key: str, trimmed: bool = False
) -> DataFrame:
    """Rows of ``df`` with the lookup's other columns, matched on ``key``.

    No broadcast hint: Spark broadcasts the lookup while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where adaptive
    execution splits a skewed key. ``trimmed`` compares without surrounding blanks; ``df``
    keeps its own spelling of the key.
    """
    values = [c for c in lookup.columns if c != key]
    spelled = F.trim if trimmed else F.col
    left = df.withColumn("_key", spelled(key))
    right = lookup.select(spelled(key).alias("_key"), *values)
    return left.join(right, "_key").drop("_key")
