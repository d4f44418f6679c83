"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct shingles of five words, as 64-bit hashes. Its sketch has
``REGISTERS`` buckets by the leading bits of a hash; a bucket keeps, of its smallest hash, the
number of leading zeros and ten more bits (the mantissa), 16 bits in all. An empty bucket takes the
register of the first filled bucket in an order of its own, so that short texts sketch as
well as long ones. Four registers make a band key.

1. Documents with one set form a class; its smallest doc_id stands for it.
2. Classes that share a band key are in a bucket. Each bucket has a centre, the class that
   shares most buckets with others, and each member is compared with the centre only.
3. Links make components, and most buckets then hold one. The members of the others are joined by
   their rare shingles (a prefix join) and pairs of different components are compared, so no link that a
   bucket shows is lost, a large group of near copies costs a comparison per member, and documents that
   share a common passage only are not paired.
4. A comparison estimates the similarity from the registers, corrected for registers that agree by
   chance, drops the pair only when it lies ``SIGMAS`` deviations below the threshold, and else counts
   both full sets.

With four registers to a band and 32 bands, two sets of similarity 0.75 share no band key with
a chance of 6 in a million.

Defined cases: null or empty texts have an empty set and no link; repeated rows and rows that
share a doc_id count as one document; a row without doc_id has component null unless another copy has
an id; an empty table gives an empty result. ``kept_rows`` decides by row instead, see there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import SPACE_CLASS, Store, fresh, table
from .components import components
from .words import text_shingles

WIDTH = 5
LEAST = 75  # hundredths
REGISTERS = 128
PER_BAND = 4
MANTISSA = 10
SIGMAS = 5
#: Numbers of 64 bits that tell for each of so many buckets whether a set has an odd number of hashes in it.
ODDS = 8
#: Registers of two unrelated hashes agree if leading zeros (a third) and mantissa do.
BY_CHANCE = 1 / 3 / 2 ** MANTISSA

_TOP = np.uint64(64 - REGISTERS.bit_length() + 1)
_EDGES = (np.arange(REGISTERS, dtype=np.uint64) << _TOP)
_ORDERS = np.argsort(np.random.default_rng(7).random((REGISTERS, REGISTERS)), axis=1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of hashes, 16 bits to a bucket."""
    at = np.searchsorted(hashes, _EDGES)
    filled = np.diff(at, append=len(hashes)) > 0
    low = hashes[np.where(filled, at, 0)] << np.uint64(64 - int(_TOP))
    part, power = np.frexp(low.astype(np.float64))
    zeros = np.clip(64 - power, 0, 63)
    out = ((zeros << MANTISSA) | np.where(low > 0, (part * 2 - 1) * 2 ** MANTISSA, 0).astype(np.int64)).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDERS[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of the sketches in each row, corrected for agreement by chance."""
    return ((a == b).mean(axis=1) - BY_CHANCE) / (1 - BY_CHANCE)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for hashes in text_shingles(batch.column("text"), WIDTH):
            sizes.append(len(hashes))
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
            bands.append(registers(hashes).view(np.int64) if len(hashes) else None)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("version"), pa.array(sizes, pa.int64()),
            pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
        ], ["doc_id", "version", "n", "content", "bands"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough. The rows of a centre come together, so its set is
    made once."""
    known: tuple = (None, None)
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [np.stack(batch.column(c).to_numpy(zero_copy_only=False)).view(np.uint16) for c in ("a_bands", "b_bands")]
        sizes = np.minimum(batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy())
        filled = np.maximum(1, 0.8 * REGISTERS * (1 - np.exp(-sizes / REGISTERS)))
        least = LEAST / 100
        near = estimate(*sides) >= least - SIGMAS * np.sqrt(least * (1 - least) / filled)
        rows = batch.filter(pa.array(near))
        good = []
        keys = zip(rows.column("b").to_pylist(), rows.column("b_version").to_pylist())
        for i, (key, left) in enumerate(zip(keys, text_shingles(rows.column("a_text"), WIDTH))):
            if known[0] != key:
                known = (key, next(text_shingles(rows.column("b_text").slice(i, 1), WIDTH)))
            both = np.intersect1d(left, known[1], assume_unique=True).size
            good.append(100 * both >= LEAST * (len(left) + len(known[1]) - both))
        yield rows.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, a_version, b, b_version) that are linked: a, b. Both sides join by their
    key alone, so adaptive execution can split a centre with very many pairs."""
    def side(x: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(x), F.col("version").alias(f"{x}_version"), F.col("n").alias(f"{x}_n"),
                            F.col("bands").alias(f"{x}_bands"), F.col("text").alias(f"{x}_text"))

    both = pairs.join(side("a"), ["a", "a_version"]).join(side("b"), ["b", "b_version"])
    columns = ["a", "a_n", "a_bands", "a_text", "b", "b_version", "b_n", "b_bands", "b_text"]
    return both.select(*columns).mapInArrow(_confirmed, "a long, b long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, odds = [], []
        for hashes in text_shingles(batch.column("text"), WIDTH):
            sets.append(hashes.view(np.int64))
            counts = np.bincount((hashes % np.uint64(64 * ODDS)).astype(np.int64), minlength=64 * ODDS)
            odds.append(np.packbits((counts & 1).astype(np.uint8)).view(np.int64))
        columns = ["doc_id", "version", "n", "component"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), *(pa.array(x, pa.list_(pa.int64())) for x in (odds, sets))], [*columns, "odds", "shingles"])


def _possible(members: DataFrame, texts: DataFrame, store: Store) -> DataFrame:
    """Pairs (a, a_version, b, b_version) of different components among ``members`` that may be linked; none
    that is linked is left out.

    Two linked sets share one of the first shingles of both, in an order from rare to common: of n
    shingles, as many as a link may lack, and one more. Shingles that no other member has count as
    lacking, so documents that share just a common passage are never paired. Of a shingle's holders
    those outside its main component are paired with the others, unless the sizes or the buckets with an
    odd number of hashes tell that too few shingles are shared.
    """
    sets = store.put(members.join(texts.select("doc_id", "version", "text"), ["doc_id", "version"]).select(
        "doc_id", "version", "n", "component", "text").mapInArrow(
        _sets, "doc_id long, version long, n long, component long, odds array<long>, shingles array<long>"), "sets")
    who = ["doc_id", "version", "n", "component", "odds"]
    each = sets.select("doc_id", "version", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    held = each.join(common, "shingle").groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("shared"))
    held = held.join(sets.drop("shingles"), ["doc_id", "version"]).withColumn("m", F.size("shared").cast("long")).where(F.col("m") * 100 >= F.col("n") * LEAST)
    # The n - m shingles without other holder would come first.
    first = F.floor(F.col("n") - F.col("n") * LEAST / 100).cast("int") + 1 - (F.col("n") - F.col("m")).cast("int")
    ordered = held.select(*who, "m", F.posexplode(F.slice("shared", F.lit(1), F.greatest(first, F.lit(0)))).alias("at", "x"))
    ordered = store.put(ordered.select(*who, "m", F.col("at").cast("long").alias("at"), F.col("x.shingle").alias("shingle")), "ordered")
    store.drop("sets")
    sizes = ordered.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("shingle").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("size", "component")).alias("main")).where("parts > 1")
    rows = ordered.join(mixed.drop("parts"), "shingle")

    def side(x: str) -> DataFrame:
        names = {"doc_id": x, **{c: f"{x}_{c}" for c in ("version", "n", "m", "at", "component", "odds")}}
        return rows.select("shingle", "main", *[F.col(c).alias(n) for c, n in names.items()])

    left, right = side("a").where(F.col("a_component") != F.col("main")), side("b").drop("main").withColumnRenamed("shingle", "of")
    # Each bucket that is odd on one side only holds a shingle that the other side lacks.
    differ = sum(F.bit_count(F.get("a_odds", F.lit(i)).bitwiseXOR(F.get("b_odds", F.lit(i)))) for i in range(ODDS))
    both_n = F.col("a_n") + F.col("b_n")
    most = F.least("a_at", "b_at") + F.least(F.col("a_m") - F.col("a_at"), F.col("b_m") - F.col("b_at"))
    return left.join(right, (left["shingle"] == right["of"]) & (F.col("a_component") != F.col("b_component"))
                     & ((F.col("b_component") == F.col("main")) | (F.col("a") < F.col("b")))
                     & (most * (100 + LEAST) >= both_n * LEAST) & (differ * (100 + LEAST) <= both_n * (100 - LEAST)))


def _open(shared: DataFrame, groups: DataFrame, store: Store) -> DataFrame:
    """The rows of buckets that hold several components."""
    placed = store.put(shared.join(groups, shared["doc_id"] == groups["id"], "left").select(
        "band", "key", "doc_id", "version", "n", F.coalesce("component", "doc_id").alias("component")), "placed")
    parts = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(parts.where("low <> high").select("band", "key"), ["band", "key"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    store = Store(docs.sparkSession, "minhash")
    versions = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"))
    sketches = store.put(versions.select("doc_id", "version", "text").mapInArrow(
        _sketches, "doc_id long, version long, n long, content binary, bands array<long>"), "sketches")
    known = sketches.where("content is not null and doc_id is not null")
    classes = store.put(known.groupBy("content").agg(
        F.min_by(F.struct("doc_id", "version", "n", "bands"), F.struct("doc_id", "version")).alias("c")).select("content", "c.*"), "classes")

    rows = classes.select("doc_id", "version", "n", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    shared = store.put(rows.join(shared, ["band", "key"]), "shared")
    weights = shared.groupBy("doc_id", "version").agg(F.sum("members").alias("weight"))
    weighed = shared.join(weights, ["doc_id", "version"])
    centres = weighed.groupBy("band", "key").agg(F.max_by(
        F.struct("doc_id", "version", "n"), F.struct("weight", -F.col("doc_id"), "version")).alias("c"))
    able = (F.col("a_n") * 100 >= F.col("b_n") * LEAST) & (F.col("b_n") * 100 >= F.col("a_n") * LEAST)
    a_side = [F.col("doc_id").alias("a"), F.col("version").alias("a_version"), F.col("n").alias("a_n")]
    stars = store.put(
        shared.join(centres, ["band", "key"])
        .select(*a_side, F.col("c.doc_id").alias("b"), F.col("c.version").alias("b_version"), F.col("c.n").alias("b_n"))
        .where((F.col("a") != F.col("b")) & able).select("a", "a_version", "b", "b_version").distinct(), "stars")
    wanted = shared.select("doc_id", "version").distinct()
    texts = store.put(
        versions.join(wanted, ["doc_id", "version"], "left_semi").dropDuplicates(["doc_id", "version"])
        .join(classes.drop("content"), ["doc_id", "version"]), "texts")
    links = store.put(_confirm(stars, texts), "links")

    groups = components(links, store, "first")
    members = _open(shared, groups, store)
    members = members.select("doc_id", "version", "n", "component").distinct()
    rest = _possible(store.put(members, "members"), texts, store)
    rest = rest.select("a", "a_version", "b", "b_version").distinct()
    rest = rest.join(stars, ["a", "a_version", "b", "b_version"], "left_anti")
    more = store.put(_confirm(store.put(rest, "rest"), texts), "more")
    if not more.isEmpty():
        # What is known already goes in as stars, which need no further round.
        stars_now = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
        groups = components(stars_now.unionByName(more), store, "last")

    of_class = classes.select("content", F.col("doc_id").alias("head")).join(
        groups, F.col("head") == groups["id"], "left").select("content", F.coalesce("component", "head").alias("component"))
    found = sketches.select("doc_id", "n", "content").join(of_class, "content", "left")
    component = F.coalesce("component", "doc_id")
    out = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))
    store.drop("shared", "texts", "members", "placed", "stars", "rest", "ordered")
    return out


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each group.

    Each row is numbered and takes part by its number, so rows without doc_id, and different texts of one doc_id, are
    rows like others. The row with the smallest doc_id stays; one without comes last. Rows without shingles
    are one group if doc_id and text are equal."""
    store, row = Store(docs.sparkSession, "kept"), fresh(docs, "row")
    rows = store.put(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("number"), "n_shingles", "component_id")
    rest = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    ranks = rows.select(F.col(row).alias("number"), F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", rest.alias("rest"), F.col(row).alias("at")).alias("rank"),
                        F.when(~F.col("text").rlike(rf"[^{SPACE_CLASS}]"), F.col("text")).alias("blank"))
    empty = F.col("n_shingles") == 0
    groups = found.join(ranks, "number").groupBy(
        F.when(~empty, F.col("component_id")).alias("of"), F.when(empty, F.col("rank.doc_id")).alias("id"), F.when(empty, F.col("blank")).alias("blank"))
    stay = groups.agg(F.min("rank").alias("first")).select(F.col("first.at").alias(row))
    return rows.join(stay, row, "left_semi").select(*docs.columns)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
