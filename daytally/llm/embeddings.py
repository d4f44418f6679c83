"""Near-duplicate vectors by iterative quantisation (ITQ) and multi-index Hamming tables.

1. Equal vectors of a label form one class that a representative stands for.
2. ITQ learns, on a sample of at most ``SAMPLE`` vectors, the principal directions and a rotation that
   brings them close to the corners of a cube, so that signs make balanced codes of 64 bits. Every
   vector gets a code.
3. A code is cut into four parts of 16 bits. Each part with its label is a bucket of one table; the
   other side probes its own value and the 16 values one bit away. Two codes that differ in up to seven
   bits meet in some table, and most of those that differ in more do. A pair is emitted by the first
   table that shows it only, and only if the whole codes differ in at most ``APART`` bits.
4. Pairs are reranked by the cosine of the original vectors in double precision; those of
   ``LEAST`` or above are links.

Recall against brute force is measured in the tests and must be at least 0.9; vectors at the threshold,
21.6 degrees apart, differ in 7.7 of 64 bits on average.

Defined cases: a vector that is null, empty, zero or holds null or non-finite numbers, and one
without label, links with nothing; vectors of different length don't link; repeated rows are
vectors of their own that link; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Store, table
from .components import components

LEAST = 0.93
SAMPLE = 8192
BITS, PARTS = 64, 4
APART = 18
_WIDE = BITS // PARTS


def learn(x: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of the codes: principal directions turned by the ITQ rotation. With fewer
    dimensions than bits, further bits are random directions."""
    rng = np.random.default_rng(11)
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:BITS].T
    v = (x - mean) @ axes
    turn = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v, full_matrices=False)
        turn = (u @ w).T
    project = axes @ turn
    if project.shape[1] < BITS:
        project = np.column_stack([project, rng.normal(size=(x.shape[1], BITS - project.shape[1]))])
    return mean, project


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as unit vectors of ``size`` numbers, cut or filled with zeros."""
    out = np.zeros((len(column), size))
    for i, row in enumerate(column):
        row = row.values.to_numpy(zero_copy_only=False)[:size]
        out[i, : len(row)] = row
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-300)[:, None]


def _codes(model: tuple[np.ndarray, np.ndarray]):
    mean, project = model
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = (matrix(batch.column("embedding"), len(mean)) - mean) @ project >= 0
            code = (bits * weights).sum(axis=1, dtype=np.uint64).view(np.int64) if len(bits) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])
    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = []
        for name in ("a_vector", "b_vector"):
            lists = batch.column(name)
            sides.append(lists.flatten().to_numpy(zero_copy_only=False).astype(float))
        size = np.diff(batch.column("a_vector").offsets.to_numpy())
        first = np.cumsum(size) - size
        dot, aa, bb = (np.add.reduceat(x * y, first) for x, y in (sides, (sides[0], sides[0]), (sides[1], sides[1])))
        keep = dot >= LEAST * np.sqrt(aa) * np.sqrt(bb)
        yield batch.select(["a", "a_mark", "b", "b_mark"]).filter(pa.array(keep))


def usable(embedding):
    """Whether a vector can link: all numbers finite, and some not zero."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda v: v != 0), F.lit(False))


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    store = Store(vectors.sparkSession, "embeddings")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    good = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    classes = store.put(rows.where(good).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes")
    sample = classes.orderBy(F.xxhash64("id", "label")).limit(SAMPLE).select("embedding").collect()
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    size = max(len(r[0]) for r in sample)
    model = learn(matrix(pa.array([r[0] for r in sample], pa.list_(pa.float64())), size))
    # A repeated vec_id may name different vectors; the mark tells them apart.
    marked = classes.select("label", "embedding", "id", F.xxhash64("label", "embedding").alias("mark"), "copies")
    kind = dict(rows.dtypes)["label"]
    coded = store.put(marked.mapInArrow(
        _codes(model), f"label {kind}, embedding array<double>, id long, mark long, copies long, code long"), "coded")

    part = lambda code, t: F.shiftrightunsigned(code, t * _WIDE).bitwiseAND(F.lit((1 << _WIDE) - 1))
    short = coded.select("label", F.size("embedding").alias("dims"), "id", "mark", "code")
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), part(F.col("code"), t).alias("value")) for t in range(PARTS)]))
    held = short.select("*", tables.alias("x")).select("label", "dims", "x.*", F.col("id").alias("a"), F.col("mark").alias("a_mark"), F.col("code").alias("a_code"))
    flips = F.explode(F.array(*[F.lit(m) for m in (0, *(1 << i for i in range(_WIDE)))]))
    probes = (
        short.select("*", tables.alias("x")).select("label", "dims", "x.*", "id", "mark", "code").withColumn("flip", flips)
        .select("label", "dims", "t", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), F.col("id").alias("b"), F.col("mark").alias("b_mark"), F.col("code").alias("b_code"))
    )
    differ = F.col("a_code").bitwiseXOR(F.col("b_code"))
    first = F.lit(True)
    for t in range(PARTS - 1):
        first = first & ((F.col("h.t") <= t) | (F.bit_count(part(differ, t)) > 1))
    on = ["label", "dims", "t", "value"]
    meet = held.alias("h").join(probes.alias("p"), [F.col(f"h.{c}") == F.col(f"p.{c}") for c in on] + [
        (F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("a_mark") < F.col("b_mark"))),
        F.bit_count(differ) <= APART, first])
    pairs = meet.select("a", "a_mark", "b", "b_mark")
    side = lambda x: coded.select(F.col("id").alias(x), F.col("mark").alias(f"{x}_mark"), F.col("embedding").alias(f"{x}_vector"))
    both = pairs.join(side("a"), ["a", "a_mark"]).join(side("b"), ["b", "b_mark"])
    links = store.put(both.select("a", "a_mark", "b", "b_mark", "a_vector", "b_vector").mapInArrow(
        _similar, "a long, a_mark long, b long, b_mark long"), "links")

    weight = coded.select("id", "mark", "copies")
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("b_mark").alias("a_mark"), F.col("a").alias("b"), F.col("a_mark").alias("b_mark")))
    counts = (
        ways.join(weight, (F.col("b") == F.col("id")) & (F.col("b_mark") == F.col("mark"))).groupBy("a", "a_mark").agg(F.sum("copies").alias("others"))
    )
    # Classes are the nodes: one vec_id under two labels, or with two vectors, is no bridge between them.
    node = lambda i, mark: F.concat_ws("/", i, mark)
    groups = components(links.select(node("a", "a_mark").alias("a"), node("b", "b_mark").alias("b")), store, "groups")
    smallest = groups.groupBy("component").agg(F.min(F.split("id", "/")[0].cast("long")).alias("smallest"))
    groups = groups.withColumnRenamed("id", "node").join(smallest, "component").select("node", "smallest")
    of_class = (
        coded.select("label", "embedding", "id", "mark", "copies")
        .join(counts, (F.col("id") == F.col("a")) & (F.col("mark") == F.col("a_mark")), "left")
        .join(groups, node("id", "mark") == F.col("node"), "left")
        .select(F.col("label").alias("of"), F.col("embedding").alias("vector"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("smallest", "id").alias("component"))
    )
    component = F.coalesce("component", "vec_id")
    return rows.join(of_class, (F.col("label") == F.col("of")) & (F.col("embedding") == F.col("vector")) & good, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
