"""Line dedup by a segment-partition edit join.

Lines that are equal, or within ``threshold`` insertions, deletions or substitutions of each other, are near
copies. The threshold grows with the length of the shorter line: none under 10 code points, 1 under 20, 2
under 45, then one for every ``PER_EDIT``. Classes are the connected components of these links; of a class
the line at the first place stays, by doc_id and then by place in the text.

1. Equal lines are brought together first, with their first place.
2. Shorter lines of up to 44 code points: a line is cut into as many segments as the threshold and one more. A line
   within the threshold must hold one of them unchanged, at a start that the difference in length bounds; so
   each line probes, for each length and each segment of such a line, the few starts at which that segment
   can lie if the edits left and right of it are to suffice. Lines that meet no other one are set
   aside without pairing any. Pairs of the others must also agree in how often they hold each letter, but for
   what the edits can change; this is part of the join's condition. Pairs that are left are verified by
   bit-parallel edit distance in a band, 2 * ``EDITS`` + 1 bits that move along the diagonal.
3. Longer ones: the segments have the fixed size of a class of lengths (``SIZES``), so a line probes each of its
   starts once, whatever the lengths of the others. Lines are shuffled, not probes: a partition gets a stretch of
   the lines of a range of lengths (``ranges``) and what the segments of the lines that they can be near to have
   there. Those segments are held in memory, or one part of them by key if they are many (``HELD``), and all starts in
   the stretch are looked up as they are made. The join's condition holds shifts and lengths to what the edits left
   and right of the segment allow; letters follow, then the distance word by word, which is no smaller than the
   distance and settles many lines of as many words, then a banded distance (``levenshtein``). A few ranges
   are taken at once, and their shuffled files are deleted before the next ones.

All of it is DataFrame functions.

Defined cases: a null text has no lines, the empty text has one empty line; rows with one doc_id are
one document, so a repeated row adds no line that stays, and rows of one doc_id with different texts keep the lines of
each; rows without doc_id are a document for each different text, and come first; an empty table
gives an empty result; very long lines are compared whole.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from .common import Store, table
from .components import components

EDITS = 2
SHORTEST = 20
#: (edits, first, last length) of the shorter line, for lines of few edits.
SHORT = [(1, 10, 19), (2, 20, 44)]
#: Code points to an edit of longer lines; size of a segment, first and last length of the shorter line. A line of n has
#: n // PER_EDIT + 1 such segments at least.
PER_EDIT = 15
SIZES = [(11, 45, 59), (12, 60, 104), (13, 105, 209), (14, 210, (1 << 31) - 1)]
#: Ranges of lengths that hold about as many code points each; code points to a range at least; ranges, or parts of one,
#: taken at once.
RANGES, LEAST, AT_ONCE = 24, 1 << 22, 6
#: Stretches of the longest line of a range, which go to partitions of their own; code points whose segments a task holds in memory.
STRETCHES, HELD = 8, 1 << 24
#: Edits of one word up to which lines of as many words are compared word by word.
WORD_EDITS = 16
#: Spark's setting by which a query's shuffled files are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting by which rows that are dealt out by some of a join's keys need not be dealt out again.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: A line's place as one number of 126 bits, the highest first: whether there is a doc_id (1 bit), the doc_id or
#: else a hash of the text (64), another hash of the text (31), the place in the text (30).
PLACES, HASHES = 1 << 30, 1 << 31


@contextmanager
def setting(spark: SparkSession, key: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffled files behind; what they give is stored."""
    with setting(spark, CLEANUP, "true", "false"):
        yield


def _number(value: int | Column, digits: int = 38) -> Column:
    return (value if isinstance(value, Column) else F.lit(Decimal(value))).cast(f"decimal({digits},0)")


def _part(number: Column, size: int) -> tuple[Column, Column]:
    """A number without its last digit to the base ``size``, and that digit."""
    last = F.pmod(number, _number(size, 20))
    return F.floor((number - last) / _number(size, 20)), last


def _document(doc_id: Column, text: Column) -> Column:
    """Number of a document, by which documents sort: a row's doc_id, or its text if it has none (those come first)."""
    named = _number(doc_id.cast("long"), 20) + _number(3 << 63, 21)
    return _number(F.coalesce(named, _number(F.xxhash64(text), 20) + _number(1 << 63, 20)), 21)


def _node(document: Column, text: Column, place: Column) -> Column:
    """Rows of one document that differ in their text have lines of their own."""
    row = _number(document * _number(HASHES, 10), 30) + _number(F.pmod(F.xxhash64(F.lit(1), text), F.lit(HASHES)), 10)
    return _number(_number(row, 30) * _number(PLACES, 10)) + _number(place, 10)


def _document_of(node: Column) -> Column:
    return _number(_part(node, PLACES * HASHES)[0], 21)


def _place_of(node: Column) -> Column:
    return _part(node, PLACES)[1].cast("long")


def _id_of(document: Column) -> Column:
    """The doc_id of a document's number, null if it has none."""
    return F.when(document >= _number(1 << 64, 21), (document - _number(3 << 63, 21)).cast("long"))


def _starts(length: Column, segment: int, edits: int) -> tuple[Column, Column]:
    """First code point (from 0) and size of a segment of a line."""
    low = F.floor(length * segment / (edits + 1)).cast("int")
    return low, F.floor(length * (segment + 1) / (edits + 1)).cast("int") - low


def segment_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    keys = []
    for i in range(edits + 1):
        low, size = _starts(length, i, edits)
        keys.append(F.xxhash64(length, F.lit(i), F.substring(line, low + 1, size)))
    return F.array(*keys)


def probe_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    """(key, shorter): what to look for, and by how much the indexed line is shorter."""
    probes = []
    for shorter in range(edits + 1):
        other = length - shorter
        for i in range(edits + 1):
            low, size = _starts(other, i, edits)
            # Edits to the left of the segment shift its start by i at most, those to the right leave the rest.
            first, last = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for shift in range(first, last + 1):
                at = low + shift
                key = F.when((at >= 0) & (other >= edits + 1), F.xxhash64(other, F.lit(i), F.substring(line, at + 1, size)))
                probes.append(F.struct(key.alias("key"), F.lit(shorter).cast("tinyint").alias("shorter")))
    return F.filter(F.array(*probes), lambda p: p["key"].isNotNull())


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two lines, arrays of characters with ``a`` at least as long as ``b``, differ by at most
    ``edits`` edits. Bit r of the words at column j stands for row j - edits + r."""
    ones = (1 << (2 * edits + 1)) - 1
    top, m, n = 1 << (2 * edits), F.size(a), F.size(b)

    def word(x: Column) -> Column:
        return x.bitwiseAND(F.lit(ones))

    def step(state: Column, j: Column) -> Column:
        vp, vn, char = state["vp"], state["vn"], F.get(b, j)
        match = F.lit(0)
        for r in range(2 * edits + 1):
            row = j + (r - edits)
            match = match + F.when((row >= 0) & (row < m) & (F.get(a, row) == char), 1 << r).otherwise(0)
        return F.struct(vp.alias("vp"), vn.alias("vn"), match.alias("x"), state["dist"].alias("dist"), state["mask"].alias("mask"))

    def diagonal(s: Column) -> Column:
        return word((s["x"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(s["x"]).bitwiseOR(s["vn"]))

    def turn(s: Column, j: Column) -> Column:
        """New words from a state with d0."""
        d0, vp, vn = s["d0"], s["vp"], s["vn"]
        hp = word(vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        along = j < m - edits
        change = F.when(along, F.when(d0.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)).otherwise(
            F.when(hp.bitwiseAND(s["mask"]) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(s["mask"]) != 0, 1).otherwise(0))
        return F.struct(
            hn.bitwiseOR(word(F.bitwise_not(down.bitwiseOR(hp)))).alias("vp"), down.bitwiseAND(hp).alias("vn"),
            (s["dist"] + change).alias("dist"), F.when(along, s["mask"]).otherwise(F.shiftright(s["mask"], 1)).alias("mask"))

    def column(state: Column, j: Column) -> Column:
        seen = step(state, j)
        held = F.transform(F.array(seen), lambda s: s.withField("d0", diagonal(s)))
        return F.get(F.transform(held, lambda s: turn(s, j)), F.lit(0))

    start = F.struct(
        F.lit(ones & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("dist"), F.lit(top >> 1).alias("mask"))
    far = F.aggregate(F.sequence(F.lit(0), n - 1), start, column, lambda s: s["dist"])
    return F.when((m - n > edits) | (m < edits) | (n < 1), m <= edits).otherwise(far <= edits)


def distinct_lines(docs: DataFrame) -> DataFrame:
    """line, node (its first place) and length, for each different line of ``docs`` (doc_id, text)."""
    lines = docs.select("doc_id", "text", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    node = _node(_document(F.col("doc_id"), F.col("text")), F.col("text"), F.col("place"))
    first = lines.select("line", node.alias("node")).groupBy("line").agg(F.min("node").alias("node"))
    return first.withColumn("length", F.length("line"))


def _index(lines: DataFrame, *more: Column, edits: int = EDITS) -> DataFrame:
    return lines.select(F.col("id").alias("b"), *more, F.explode(segment_keys(F.col("line"), F.col("length"), edits)).alias("key"))


def _probes(lines: DataFrame, *more: Column, edits: int = EDITS) -> DataFrame:
    keys = F.explode(probe_keys(F.col("line"), F.col("length"), edits)).alias("p")
    return lines.select(F.col("id").alias("a"), *more, keys).select("*", "p.*").drop("p")


def letters(line: str) -> Column:
    """How often each small letter occurs in a line, and how many other characters there are. An
    edit changes two of the numbers by one at most."""
    counts = [(c, F.length(line) - F.length(F.replace(F.col(line), F.lit(c), F.lit("")))) for c in string.ascii_lowercase]
    rest = F.length(line) - sum(n for _, n in counts)
    return F.struct(*[n.alias(c) for c, n in counts], rest.alias("rest"))


def threshold(length: int) -> int:
    """Edits that a line of ``length`` code points may differ by from one as long or longer."""
    return next((e for e, first, last in SHORT if first <= length <= last), 0 if length < SHORT[0][1] else length // PER_EDIT)


def near_lines(lines: DataFrame, store: Store, edits: int = EDITS, shortest: int = SHORTEST, longest: int | None = None) -> DataFrame:
    """Links (a, b) between nodes of ``lines`` (line, node, length): pairs within ``edits`` edits whose shorter line has
    ``shortest`` to ``longest`` code points."""
    long = lines.where(F.col("length") >= shortest).withColumn("id", F.xxhash64("line"))
    first = F.lit(True)
    if longest is not None:
        long, first = long.where(F.col("length") <= longest + edits), F.col("length") <= longest
    name = {n: f"{n}{shortest}" for n in ("ids", "texts", "pairs", "links")}
    # Lines that meet another one; a key's smallest and largest line stand for all, so nothing is paired.
    index, probes = _index(long.where(first), edits=edits), _probes(long, edits=edits)
    known = index.groupBy("key").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    hits = probes.join(known, "key").where((F.col("a") != F.col("low")) | (F.col("a") != F.col("high")))
    ids = store.put(hits.select(F.explode(F.array("a", "low", "high")).alias("wanted")).distinct(), name["ids"])
    texts = store.put(long.join(ids, F.col("id") == F.col("wanted"), "left_semi").withColumn("bag", letters("line")), name["texts"])
    apart = sum(F.abs(F.col(f"a_bag.{c}") - F.col(f"b_bag.{c}")) for c in texts.schema["bag"].dataType.names)
    left, right = _probes(texts, F.col("bag").alias("a_bag"), edits=edits), _index(texts.where(first), F.col("bag").alias("b_bag"), edits=edits)
    meet = left.join(right, (left["key"] == right["key"]) & (F.col("a") != F.col("b"))
                     & ((F.col("shorter") > 0) | (F.col("a") < F.col("b"))) & (apart <= 2 * edits))
    pairs = store.put(meet.select("a", "b").distinct(), name["pairs"])

    def side(x: str) -> DataFrame:
        return texts.select(F.col("id").alias(x), F.col("node").alias(f"{x}_node"), F.col("line").alias(f"{x}_line"), F.col("length").alias(f"{x}_length"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.abs(F.col("a_length") - F.col("b_length")) <= edits)
    a, b = F.split("a_line", ""), F.split("b_line", "")
    chars = both.select(
        "a_node", "b_node",
        F.slice(F.when(F.col("a_length") >= F.col("b_length"), a).otherwise(b), F.lit(1), F.greatest("a_length", "b_length")).alias("longer"),
        F.slice(F.when(F.col("a_length") >= F.col("b_length"), b).otherwise(a), F.lit(1), F.least("a_length", "b_length")).alias("other"))
    # The lambda's argument holds both arrays, so they are made once for a pair.
    near = F.exists(F.array(F.struct("longer", "other")), lambda p: within(p["longer"], p["other"], edits))
    links = store.put(chars.where(near).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), name["links"])
    store.drop(name["pairs"], name["ids"], name["texts"])
    return links


def _step(x: Column) -> Column:
    """Number of a place or length on a scale whose steps grow with it."""
    return F.floor(F.log(x + 1) / math.log(1 + 1 / PER_EDIT)).cast("int")


def _steps(lines: DataFrame) -> list[Row]:
    """first, last length and size (code points) of each step of lengths."""
    length = F.col("length")
    return lines.groupBy(_step(length).alias("step")).agg(
        F.min("length").alias("first"), F.max("length").alias("last"), F.sum(length.cast("long")).alias("size")).orderBy("step").collect()


def ranges(lines: DataFrame) -> list[tuple[int, int, int]]:
    """(first, last length, parts): all lengths of ``lines`` in ranges of about one ``RANGES``-th of the code points. A step
    of lengths that holds more is a range of its own, whose keys are to be taken in so many parts."""
    return _ranges(_steps(lines))


def _ranges(steps: list[Row]) -> list[tuple[int, int, int]]:
    most, out, held = max(LEAST, sum(s["size"] for s in steps) / RANGES), [], math.inf
    for s in steps:
        if held + s["size"] <= most:
            out[-1], held = (out[-1][0], s["last"], 1), held + s["size"]
        else:
            out.append((s["first"], s["last"], math.ceil(s["size"] / most)))
            held = s["size"]
    return out


def _whole(x: Column, by: int | Column) -> Column:
    return F.floor(x / by).cast("int")


def _slots(steps: list[Row]) -> list[Row]:
    """Ranges of lengths, each with its first partition, the code points of a stretch, and in how many parts by key the segments
    are held that a line of the range can meet in one."""
    slots, first = [], 0
    for low, high, parts in _ranges(steps):
        held = sum(s["size"] for s in steps if s["last"] >= low - low // PER_EDIT and s["first"] <= high)
        parts = max(parts, math.ceil(held * (1 / STRETCHES + 1 / PER_EDIT) / HELD))
        slots.append(Row(first=first, low=low, high=high, stretch=high // STRETCHES + 1, parts=parts))
        first += STRETCHES * parts
    return slots


def _at_once(slots: list[Row]) -> list[list[Row]]:
    out, held = [], math.inf
    for s in slots:
        if held + s.parts > AT_ONCE:
            out.append([])
            held = 0
        out[-1].append(s)
        held += s.parts
    return out


def _met(lines: DataFrame, slots: list[Row], meets, sizes) -> DataFrame:
    """A row for each range of lengths that a line meets and each size of segments."""
    held = F.filter(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in s.asDict().items()]) for s in slots]), meets)
    able = F.filter(F.array(*[F.when(sizes(first, last), size) for size, first, last in SIZES]), lambda x: x.isNotNull())
    rows = lines.select("id", "length", "line", able.alias("sizes"), F.explode(held).alias("s")).select("id", "length", "line", F.explode("sizes").alias("size"), "s.*")
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def _dealt(pieces: DataFrame, slots: list[Row], *more: str) -> DataFrame:
    """``pieces`` (place: number of a stretch, piece) in a partition for each stretch and part, in code points of four bytes."""
    slot = F.col("first") + F.col("place") * F.col("parts") + F.col("part")
    n = 2 * STRETCHES * sum(s.parts for s in slots)
    return pieces.select(slot.alias("slot"), "id", "length", "size", "part", "parts", *more, "piece").repartition(n, "slot").withColumn("code", F.encode("piece", "UTF-32"))


def _keyed(cuts: DataFrame, at: Column) -> DataFrame:
    """``cuts`` of this part with the key of the segment ``at`` a code point of the piece."""
    keyed = cuts.withColumn("key", F.hash("size", F.substring("code", 4 * at + 1, 4 * F.col("size"))))
    return keyed.where((F.col("parts") == 1) | (F.pmod("key", "parts") == F.col("part")))


def _long_keys(long: DataFrame, slots: list[Row]) -> tuple[DataFrame, DataFrame]:
    """Segments of the lines that a longer or equal one of the lengths of ``slots`` can be near to, and all starts of
    those, by slot."""
    length, size, place, stretch, start, i = (F.col(c) for c in ("length", "size", "place", "stretch", "start", "i"))
    low, high, edits = slots[0].low, slots[-1].high, _whole(length, PER_EDIT)
    # A line can be near to one that is longer by its threshold at most; low - low // PER_EDIT is no longer than the shortest such line.
    own = _met(long.where(length.between(low - low // PER_EDIT, high)), slots, lambda s: (length <= s["high"]) & (length + edits >= s["low"]),
               lambda first, last: length.between(first, last))
    own = own.withColumn("place", F.explode(F.sequence(F.lit(0), F.least(_whole((size + 1) * edits, stretch), F.lit(STRETCHES - 1)))))
    # Segment i is shifted by i at most, and reaches the stretch if it is one of these.
    own = own.withColumn("from", F.greatest(_whole(place * stretch, size + 1), F.lit(0)))
    own = own.withColumn("to", F.least(_whole((place + 1) * stretch - 1, size - 1), edits)).where(F.col("from") <= F.col("to"))
    own = own.withColumn("piece", F.substring("line", F.col("from") * size + 1, (F.col("to") - F.col("from") + 1) * size))
    own = _dealt(own, slots, "from", "to").withColumn("i", F.explode(F.sequence("from", "to")))
    own = _keyed(own, (i - F.col("from")) * size).select("slot", "key", F.col("id").alias("b"), length.alias("b_length"), (i * size).alias("b_start"))
    starts = _met(long.where(length.between(low, high)), slots, lambda s: length.between(s["low"], s["high"]),
                  lambda first, last: length.between(first, min(last + last // PER_EDIT, (1 << 31) - 1)))
    starts = starts.withColumn("place", F.explode(F.sequence(F.lit(0), _whole(length - size, stretch)))).withColumn("from", place * stretch)
    starts = starts.withColumn("to", F.least(F.col("from") + stretch - 1, length - size))
    starts = starts.withColumn("piece", F.substring("line", F.col("from") + 1, F.col("to") - F.col("from") + size))
    starts = _dealt(starts, slots, "from", "to").withColumn("start", F.explode(F.sequence("from", "to"))).withColumn("i", _whole(start, size))
    # The segments next to a start reach it if any does.
    starts = starts.where((start - i * size <= i) | ((i + 1) * size - start <= i + 1))
    starts = _keyed(starts, start - F.col("from")).select("slot", "key", F.col("id").alias("a"), length.alias("a_length"), start.alias("a_start"), "size")
    return own, starts


def _by_words(a: str, b: str, edits: Column) -> Column:
    """Whether two lines of as many words are within ``edits`` word by word, so that their distance is no larger. Others may be
    within them too."""
    def change(x: Column, y: Column) -> Column:
        far = F.levenshtein(x, y, WORD_EDITS).cast("long")
        return F.when(x == y, 0).when(far < 0, 1 << 31).otherwise(far)

    words = F.array(F.struct(F.split(a, " ").alias("a"), F.split(b, " ").alias("b")))
    return F.exists(words, lambda w: F.when(F.size(w["a"]) == F.size(w["b"]), F.aggregate(
        F.zip_with(w["a"], w["b"], change), F.lit(0).cast("long"), lambda n, d: n + d) <= edits).otherwise(False))


def near_long_lines(lines: DataFrame, store: Store) -> DataFrame:
    """Links (a, b) between nodes of ``lines`` whose shorter line has so many code points that the threshold is one edit for
    every ``PER_EDIT``."""
    long = lines.where(F.col("length") >= SIZES[0][1]).withColumn("id", F.xxhash64("line"))
    edits = _whole(F.col("b_length"), PER_EDIT)
    i = _whole(F.col("b_start"), F.col("size"))
    more, shift = F.col("a_length") - F.col("b_length"), F.col("a_start") - F.col("b_start")
    fits = ((more >= 0) & (more <= edits) & (F.abs(shift) <= i) & (F.abs(more - shift) <= edits - i)
            & (F.col("a") != F.col("b")) & ((more > 0) | (F.col("a") < F.col("b"))))
    pairs, names, slots = long.select(F.col("id").alias("a"), F.col("id").alias("b")).where(F.lit(False)), [], _slots(_steps(long))
    for some in _at_once(slots):
        index, probes = _long_keys(long, some)
        names.append(f"long_pairs{len(names)}")
        with setting(long.sparkSession, ALL_KEYS, "false", "true"):
            pairs = pairs.unionByName(store.put(probes.join(index.hint("shuffle_hash"), ["slot", "key"]).where(fits).select("a", "b").distinct(), names[-1]))
    if any(s.parts > 1 for s in slots):
        pairs = pairs.distinct()
    met = pairs.select(F.explode(F.array("a", "b")).alias("wanted")).distinct()
    texts = store.put(long.join(met, F.col("id") == F.col("wanted"), "left_semi").withColumn("bag", letters("line")), "long_texts")

    def side(x: str, *more: str) -> DataFrame:
        return texts.select(F.col("id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in more])

    apart = sum(F.abs(F.col(f"a_bag.{c}") - F.col(f"b_bag.{c}")) for c in texts.schema["bag"].dataType.names)
    # The letters that one line has more of make up ``more`` more than those that the other one has more of; neither can be more than the edits.
    alike = pairs.join(side("a", "bag", "length"), "a").join(side("b", "bag", "length"), "b").where(apart + more <= 2 * edits).select("a", "b")
    both = alike.join(side("a", "line", "node"), "a").join(side("b", "line", "node", "length"), "b")
    near = _by_words("a_line", "b_line", edits) | F.expr(f"levenshtein(a_line, b_line, cast(floor(b_length / {PER_EDIT}) as int)) >= 0")
    links = store.put(both.where(near).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "long_links")
    store.drop(*names, "long_texts")
    return links


def near_by_length(lines: DataFrame, store: Store) -> DataFrame:
    """Links (a, b) between nodes of ``lines`` within the threshold of their lengths."""
    links = near_long_lines(lines, store)
    for edits, first, last in SHORT:
        links = links.unionByName(near_lines(lines, store, edits, first, last))
    return links


def line_classes(docs: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """The different lines (line, node, length, class: the node that stays) and their links."""
    with shuffles_deleted(docs.sparkSession):
        # In order of length, so that a range of lengths is read without the rest.
        lines = store.put(distinct_lines(docs).sortWithinPartitions("length"), "lines")
        links = near_by_length(lines, store)
        classes = components(links, store, "classes").withColumnRenamed("component", "class")
        classed = store.put(lines.join(classes, F.col("node") == F.col("id"), "left").select(
            "line", "node", "length", F.coalesce("class", "node").alias("class")), "classed")
    store.drop("lines")
    return classed, links


def _documents(docs: DataFrame) -> DataFrame:
    """document, doc_id and n_lines, a row for each document."""
    n_lines = F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))).otherwise(0)
    rows = docs.select(_document(F.col("doc_id"), F.col("text")).alias("document"), F.col("doc_id").cast("long").alias("doc_id"), n_lines.alias("n"))
    return rows.groupBy("document").agg(F.max("doc_id").alias("doc_id"), F.sum("n").cast("long").alias("n_lines"))


def _texts(lines: DataFrame) -> DataFrame:
    """document and text of the lines that stay, for each document that keeps any."""
    return lines.where(F.col("node") == F.col("class")).groupBy(_document_of(F.col("node")).alias("document")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "line"))), lambda x: x["line"]), "\n").alias("kept"))


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id and text of the lines that stay, for each document; no document is left out."""
    lines, _ = line_classes(docs, Store(docs.sparkSession, "lines"))
    return _documents(docs).join(_texts(lines), "document", "left").select("doc_id", F.col("kept").alias("text"))


def line_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_kept (lines that stay), n_near (different lines first seen
    here that went as near copies), n_links (their and the others' links), kept_chars, digest (SHA-256 of the cleaned text;
    null if no line stays), classes (place of each line first seen here, doc_id and place of its class, in order)."""
    store = Store(docs.sparkSession, "lines")
    lines, links = line_classes(docs, store)
    stays = F.col("node") == F.col("class")
    seen = F.struct(_place_of(F.col("node")).alias("place"), _id_of(_document_of(F.col("class"))).alias("class_doc"), _place_of(F.col("class")).alias("class_place"))
    kept = lines.groupBy(_document_of(F.col("node")).alias("document")).agg(
        F.count_if(stays).alias("n_kept"), F.count_if(~stays).alias("n_near"), F.sum(F.when(stays, F.col("length"))).alias("kept_chars"),
        F.array_sort(F.collect_list(seen)).alias("classes"))
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy(_document_of(F.col("node")).alias("document")).agg(F.count("*").alias("n_links"))
    digests = _texts(lines).select("document", F.sha2(F.col("kept").cast("binary"), 256).alias("digest"))
    return (
        _documents(docs).join(kept, "document", "left").join(linked, "document", "left").join(digests, "document", "left")
        .select("doc_id", "n_lines", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_kept", "n_near", "n_links", "kept_chars")],
                "digest", F.coalesce("classes", F.array().cast(kept.schema["classes"].dataType)).alias("classes"))
    )


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_table(table(spark, sf_dir, "documents"))
