"""A layout for two ways in: by place and by day.

Rows are sorted along a Z-order curve over place and day, cut into files. Each file then holds part of the
places over part of the days: of n files, one place lies in about the square root of n, and so does one day.
Readers skip the others: by the files' smallest and largest day, and by Parquet bloom filters on
the place. One folder holds all, so the number of files follows the size of the table and not the
number of places or days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of each of the two positions.
BITS = 16
#: Places that a file's bloom filter is made for.
PLACES_IN_A_FILE = 100_000


def _apart(x: Column) -> Column:
    """The bits of a position with a free bit after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def curve(place: Column, day: Column, first: Column, last: Column) -> Column:
    """Where a row lies on the curve. Places are in the order of a hash, which deals them out evenly; days
    lie between ``first`` and ``last``, and a null day before them."""
    size = 1 << BITS
    x = F.pmod(F.xxhash64(place), F.lit(size))
    y = F.floor((F.unix_date(day) - first) * size / (last - first + 1))
    return _apart(x).bitwiseOR(F.shiftleft(_apart(F.coalesce(y, F.lit(0)).cast("bigint")), 1))


def write_clustered(df: DataFrame, path: str, place: str, day: str, files: int) -> None:
    """Replace the table at ``path`` by ``df`` in about ``files`` files of like size along the curve.

    A narrow pass finds the first and last day. A place with very many rows is split by its days.
    """
    bounds = df.agg(F.min(F.unix_date(day)).alias("first"), F.max(F.unix_date(day)).alias("last")).first()
    first, last = (F.lit(b or 0) for b in bounds)
    z = curve(F.col(place), F.col(day), first, last)
    (
        df.withColumn("_z", z).repartitionByRange(files, "_z", day, place).sortWithinPartitions("_z", place, day).drop("_z")
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{place}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{place}", str(PLACES_IN_A_FILE))
        .parquet(path)
    )
