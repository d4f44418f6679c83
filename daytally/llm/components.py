"""Connected components of a graph too large for one machine.

Two steps take turns until only stars are left. Each node's larger neighbours are linked to
its smallest neighbour (large star), then each node's smaller neighbours and the node itself are
(small star). The number of rounds grows with the logarithm of the longest chain. Minima
are combined before they are shuffled and then joined, so a node with very many neighbours
is nobody's list: the join's large partitions can be split.

Each round is written to the store, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Store


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top"))


def components(edges: DataFrame, store: Store, label: str) -> DataFrame:
    """``edges`` (a, b), any integers, to (id, component): each node that has an edge, with the
    smallest node it can reach."""
    now = store.put(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{label}0")
    turn = 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = _smallest(both)
        # Where each node with a smaller neighbour has no other one, all are stars round their smallest node.
        if not ends.where("m < u and m <> top").agg(F.count("*")).first()[0]:
            break
        # Large star: u's neighbours on both sides; those above u go to the smallest, u included.
        low = ends.select("u", F.least("u", "m").alias("m"))
        up = now.select(F.col("v").alias("u"), F.col("u").alias("w"))
        large = up.join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = store.put(large.where("u <> v"), f"{label}l{turn}")
        # Small star: each u now has smaller neighbours v; all of them go to the smallest.
        small = large.join(_smallest(large), "u")
        linked = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        after = store.put(linked.where("u <> v").distinct(), f"{label}{turn + 1}")
        store.drop(f"{label}{turn}", f"{label}l{turn}")
        now, turn = after, turn + 1
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
