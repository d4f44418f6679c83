"""Whitening of embeddings, from the exact characteristic polynomial of their scatter.

1. Each entry c becomes the integer x = floor(1024 * c) + 100000. Tasks sum the products of all pairs of
   columns, exactly, and Spark adds up the sums: n, the sums S and the products M of the whole table.
   n * M - S * S' is the integer scatter, n * n times the covariance.
2. Its characteristic polynomial is found modulo many primes, each in a task of its own, by reduction to
   Hessenberg form; Chinese remaindering gives the integer coefficients.
3. The largest roots are separated by counts of sign changes and narrowed to 128 bits after the point.
4. A task for each root finds its vectors by inverse iteration in fixed point (see ``charpoly``).
5. One pass over the vectors projects them. The covariance of what it wrote is then taken by Spark, and
   its distance from the identity is reported with each row.

What the driver holds grows with the square of the dimension and not with the number of vectors.

Defined cases: a vector that is null or holds null, NaN or infinity is left out, and so is one with an
entry beyond 2 ** 62 / 1024, whose integer has no place in a long. The dimension is the commonest length
of the others (the smaller one of equally common), and vectors of another length, empty ones included, are
left out. Repeated rows all count. A component without variance can't be whitened, so fewer than ``MOST``
components are given where the scatter has a lower rank: none for equal vectors, a single one or an empty
table. Components with equal variance are some orthogonal set of their space, the same in each run.
A null vec_id is an id like any other.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import charpoly
from .common import Store, table

SCALE, SHIFT = 1024, 100_000
#: Components given.
MOST = 8
#: Entries that a task handles at once.
SLICE = 1 << 20
LIMB = 16
#: Sums are shuffled as high and low parts, so that neither outgrows a decimal.
LOW = 60


def integers(vectors: DataFrame) -> DataFrame:
    """The usable rows of ``vectors`` (vec_id, embedding) as (vec_id, x)."""
    usable = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < float(2 ** 62)))
    rows = vectors.where(F.coalesce(usable, F.lit(False)) & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return rows.where(F.size("embedding") == (lengths["d"] if lengths else 0)).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = max(1, SLICE * batch.num_rows // max(1, len(batch.column("x").flatten())))
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def gram(x: np.ndarray) -> np.ndarray:
    """x' * x in Python integers. Columns are cut into 16 bits each, whose products and their sums over
    up to 2 ** 20 rows are exact in floating point."""
    parts = []
    while x.min() < -(1 << LIMB) or x.max() >= 1 << LIMB:
        parts.append((x & ((1 << LIMB) - 1)).astype(float))
        x = x >> LIMB
    parts.append(x.astype(float))
    return sum((a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j) for i, a in enumerate(parts) for j, b in enumerate(parts))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in slices(batches):
        x = matrix(batch.column("x"))
        own = gram(np.column_stack([np.ones(len(x), np.int64), x]))
        total = own if total is None else total + own
    if total is not None:
        i, j = np.triu_indices(len(total))
        low = [int(v) & ((1 << LOW) - 1) for v in total[i, j]]
        high = [int(v) >> LOW for v in total[i, j]]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(map(decimal.Decimal, part), kind) for part in (high, low))],
            ["i", "j", "high", "low"])


def scatter(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums and the integer scatter of ``rows`` (x)."""
    parts = rows.select("x").mapInArrow(_sums, "i int, j int, high decimal(38,0), low decimal(38,0)")
    got = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    if not got:
        return 0, np.zeros(0, object), np.zeros((0, 0), object)
    size = 1 + max(r["j"] for r in got)
    total = np.zeros((size, size), object)
    for r in got:
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = (int(r["high"]) << LOW) + int(r["low"])
    n, sums = total[0, 0], total[0, 1:]
    return n, sums, n * total[1:, 1:] - np.outer(sums, sums)


def _spread(spark: SparkSession, n: int) -> DataFrame:
    """The numbers 0 to n - 1, a task each as far as there are cores for."""
    return spark.range(0, n, 1, max(1, min(n, 4 * spark.sparkContext.defaultParallelism)))


def characteristic(spark: SparkSession, a: np.ndarray) -> list[int]:
    """The characteristic polynomial of the scatter, lowest coefficient first."""
    primes = charpoly.primes_for(int(np.trace(a)), len(a))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([primes[i]], pa.int64()), pa.array([charpoly.residues(a, primes[i]).tolist()], pa.list_(pa.int64()))], ["p", "c"])

    parts = _spread(spark, len(primes)).mapInArrow(run, "p long, c array<long>").collect()
    return charpoly.combined([(r["p"], r["c"]) for r in parts])


def components(spark: SparkSession, a: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the scatter, falling, and their unit vectors as rows."""
    roots = charpoly.largest_roots(characteristic(spark, a), most)
    if not roots:
        return np.zeros(0), np.zeros((0, len(a)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                root, many = roots[i]
                near = (a << charpoly.ROOT_BITS) - root * np.diag(np.ones(len(a), int).astype(object))
                found = charpoly.null_vectors(near, many)
                yield pa.RecordBatch.from_arrays([pa.array([i] * many, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["i", "v"])

    got = _spread(spark, len(roots)).mapInArrow(run, "i long, v array<double>").collect()
    got = sorted(got, key=lambda r: r["i"])[:most]
    return np.array([roots[r["i"]][0] / (1 << charpoly.ROOT_BITS) for r in got]), np.array([r["v"] for r in got])


def project(rows: DataFrame, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """vec_id, deviation and the whitened coordinates as an array. With u = n * x - S, a coordinate is
    u * v / sqrt(eigenvalue of the scatter), in which n cancels out."""
    weights = vectors.T / np.sqrt(values)
    most = decimal.Decimal(10) ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = matrix(batch.column("x"))
            reach = max(abs(int(v)) for v in (x.min(), x.max(), *sums // n)) * 2 * n
            u = n * (x if reach < 2 ** 62 else x.astype(object)) - (sums.astype(np.int64) if reach < 2 ** 62 else sums)
            exact = u if reach ** 2 * x.shape[1] < 2 ** 63 else u.astype(object)
            far = [d if (d := decimal.Decimal(int(s))) < most else None for s in (exact * exact).sum(1)]
            white = u.astype(float) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(far, pa.decimal128(38, 0)), pa.array(white.tolist(), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, many: int) -> float:
    """Largest entry of the covariance of the whitened coordinates less the identity."""
    pairs = [(i, j) for i in range(many) for j in range(i, many)]
    found = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(vectors: DataFrame, most: int = MOST) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation (a decimal of 38 digits;
    null beyond), whitened, explained, identity_error."""
    spark = vectors.sparkSession
    store = Store(spark, "whitening")
    rows = integers(vectors)
    n, sums, a = scatter(rows)
    values, axes = components(spark, a, most) if n else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = store.put(project(rows, n, sums, values, axes), "white")
    error = identity_error(white, len(values))
    explained = F.array(*[F.lit(float(v) / float(np.trace(a))) for v in values])
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` as a long, and null where it is beyond one; ``deviation_wide`` has it to 38 digits."""
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation_wide", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation as long)"))
