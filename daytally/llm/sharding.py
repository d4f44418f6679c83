"""Sharding by longest processing time.

Rows with equal texts stay together. Groups, largest first, go to the shard with the fewest
bytes so far, taken from a heap. Only a bounded list goes through the heap:

* a group above ``total / (shards * parts)`` bytes is an item of its own, and there are at most
  ``shards * parts`` of those whatever the data;
* the groups below it are dealt by their hash into a fixed number of bundles, each an item. A
  sixteenth of the groups makes up bundles a sixteenth as large, which level the shards at
  the end of the list.

Rows never pass through the driver; the list of items (``shards * (parts + 64)`` entries at most,
12,800 with the defaults) does.

Defined cases: a null text counts as the empty text (16 bytes) and all of those form one group;
repeated rows are rows of one group; an empty table gives an empty result; other columns of
the input play no part.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import Store, fresh, table

SHARDS = 40
PARTS = 256
ROW_BYTES = 16
#: Rows of a shard that one task numbers.
SLOT_ROWS = 250_000


def lpt(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size: the largest first, each to the least loaded shard. Ties go by
    place in the list and by the shard's number."""
    heap = [(0, shard) for shard in range(shards)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heap[0]
        out[i] = shard
        heapq.heapreplace(heap, (load + sizes[i], shard))
    return out


def _group(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _size(text: str):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _bundle(group: str, shards: int):
    mixed = F.xxhash64(F.col(group), F.lit(1))
    wide, fine = F.pmod(mixed, F.lit(shards * 32)), F.pmod(mixed, F.lit(shards * 32)) + shards * 32
    return F.when(F.pmod(F.xxhash64(F.col(group), F.lit(2)), F.lit(16)) == 0, fine).otherwise(wide)


def plan_groups(groups: DataFrame, shards: int = SHARDS, parts: int = PARTS) -> DataFrame:
    """``groups`` (group long, bytes long; a row per group or several that add up) to a table
    (kind, item, shard): kind 0 for a large group by its number, kind 1 for a bundle."""
    spark = groups.sparkSession
    whole = groups.groupBy("group").agg(F.sum("bytes").alias("bytes"))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") > total // (shards * parts)
    items = (
        whole.groupBy(
            F.when(large, 0).otherwise(1).alias("kind"),
            F.when(large, F.col("group")).otherwise(_bundle("group", shards)).alias("item"),
        ).agg(F.sum("bytes").alias("bytes")).collect()
    )
    items.sort(key=lambda r: (-r["bytes"], r["kind"], r["item"]))
    placed = lpt([r["bytes"] for r in items], shards)
    rows = [(r["kind"], r["item"], shard) for r, shard in zip(items, placed)]
    return spark.createDataFrame(rows, "kind int, item long, shard int")


def _placed(rows: DataFrame, plan: DataFrame, group: str, shards: int, out: str) -> DataFrame:
    """``rows`` with the shard of their group in column ``out``. The plan is bounded, see above,
    and so may be broadcast."""
    one, many = fresh(rows, "large"), fresh(rows, "bundle")
    large = plan.where("kind = 0").select(F.col("item").alias(one), F.col("shard").alias(f"{one}_s"))
    small = plan.where("kind = 1").select(F.col("item").alias(many), F.col("shard").alias(f"{many}_s"))
    return (
        rows.join(F.broadcast(large), F.col(group) == F.col(one), "left")
        .join(F.broadcast(small), _bundle(group, shards) == F.col(many), "left")
        .withColumn(out, F.coalesce(f"{one}_s", f"{many}_s"))
        .drop(one, many, f"{one}_s", f"{many}_s")
    )


def shard_rows(docs: DataFrame, shards: int = SHARDS, text: str = "text", out: str = "shard") -> DataFrame:
    """``docs`` with column ``out``, the shard of each row; texts are not shuffled."""
    group = fresh(docs, "group")
    keyed = docs.withColumn(group, _group(text))
    plan = plan_groups(keyed.select(F.col(group).alias("group"), _size(text).alias("bytes")), shards)
    return _placed(keyed, plan, group, shards, out).drop(group)


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots run from 0 without gaps within a shard. They are numbered in parallel: each shard's
    rows are dealt into parts by a hash, the parts' counts give where each starts.
    """
    spark = docs.sparkSession
    store = Store(spark, "sharding")
    rows = store.put(docs.select(
        F.col("doc_id"), _size("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        _group("text").alias("group"),
    ), "rows")
    count = rows.count()
    plan = plan_groups(rows.select("group", F.col("size").alias("bytes")), shards)
    parts = max(16, -(-count // (shards * SLOT_ROWS)))
    placed = _placed(rows, plan, "group", shards, "shard").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "group"), F.lit(parts)))
    by_shard = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(by_shard), F.lit(0)).alias("start"))
    )
    within = W.partitionBy("shard", "part").orderBy("doc_id", "group")
    return (
        placed.withColumn("nth", F.row_number().over(within) - 1)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
            (F.col("start") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"))
