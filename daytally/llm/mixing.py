"""Mixing sources to target weights, by Efraimidis-Spirakis sampling.

Each document draws a key ``-ln(u) / w`` from a number u of (0, 1) that its id fixes and its
quality weight w; within a source, small keys come first, which is weighted sampling without
replacement. A source whose target is e times its size and a remainder takes e whole epochs,
then documents in key order until their words reach the remainder: a document is taken if
the middle of its stretch of words lies within it, so that the sum is as near as whole
documents allow.

Targets: sources in code-point order, null last, weigh 5, 2, 1 in turn and share all words by
weight; a target stops at ``MOST`` times its source's size and the excess is shared again by
weight. The fixed point of that is min(MOST * size, level * weight) with one level for all, which
one pass over the sources finds.

No source is sorted as a whole. Words are summed by source and by a range of keys, which shows the
range where the remainder ends; that range is split again, and only its rows are sorted.

Defined cases: a null text has no words and is taken 0 times; a null source is a source; rows
with the same source and doc_id share a key and are taken together; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import SPACE_CLASS, WORD, Store, fresh, table, word_count

#: Weights of the sources in turn.
WEIGHTS = (5, 2, 1)
#: Times its size that a source may be taken.
MOST = 3
SEED = "mix"
#: Ranges of keys at each of the two levels.
RANGES = 1024


def quality(text):
    """Weight in [0.5, 1]: 1 less half the share of digits and signs among the characters."""
    plain = F.length(F.regexp_replace(text, r"[!-@\[-`{-~]+", ""))
    share = (F.length(text) - plain) / F.length(text)
    return F.when(F.length(text) > 0, 1 - 0.5 * share).otherwise(F.lit(0.5))


def key(doc_id, text, seed: str = SEED):
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2 ** 48)
    return -F.log(u) / quality(text)


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size; a row per source) with ``target``. One task sees a row per
    source, no documents."""
    everything = W.partitionBy()
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # From the source that fills up first: what is left for it and all after it, by weight.
    fills = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    rows = (
        rows.withColumn("left", total - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("share"))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    )
    level = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), -F.col("share"))).over(everything)
    return rows.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double"))).alias("target"),
    )


def mixing_plan(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """What each source takes: source, source_size, target, epochs, cut_key, cut_id; the last
    document of the fractional part has that key and id (null: there is none).

    ``rows``: source, doc_id, size, key; read several times, so it should be stored.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    place = 1 - F.exp(-F.col("key"))
    fine = F.least(F.floor(place * RANGES * RANGES), F.lit(RANGES * RANGES - 1))
    words = (
        rows.where("size > 0").withColumn("fine", fine).withColumn("range", F.floor(F.col("fine") / RANGES))
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    def ending(sums: DataFrame, by: str, goals: DataFrame) -> DataFrame:
        """The first range in which the words so far reach the source's rest: source, by, rest
        within it."""
        upto = W.partitionBy("source").orderBy(by)
        rest = (
            sums.join(goals.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("after", F.sum("words").over(upto))
            .withColumn("before", F.col("after") - F.col("words"))
            .where("before < rest and after >= rest")
        )
        return rest.groupBy("source").agg(F.min(by).alias(by), F.min(F.col("rest") - F.col("before")).alias("rest"))

    goals = plan.where("rest > 0")
    coarse = ending(words.groupBy("source", "range").agg(F.sum("size").alias("words")), "range", goals)
    inside = words.join(coarse.select(F.col("source").alias("s"), F.col("range").alias("r"), "rest"),
                        F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    finest = ending(inside.groupBy("source", "fine").agg(F.sum("size").alias("words")), "fine", coarse)
    last = words.join(finest.select(F.col("source").alias("s"), F.col("fine").alias("f"), "rest"),
                      F.col("source").eqNullSafe(F.col("s")) & (F.col("fine") == F.col("f")))
    # Rows with one key and id go together.
    merged = last.groupBy("source", "key", "doc_id").agg(F.sum("size").alias("size"), F.min("rest").alias("rest"))
    upto = W.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first())
    cuts = (
        merged.withColumn("middle", F.sum("size").over(upto) - F.col("size") / 2)
        .groupBy("source").agg(
            F.max(F.when(F.col("middle") <= F.col("rest"), F.struct("key", F.coalesce("doc_id", F.lit(-(2 ** 63))).alias("id")))).alias("cut"),
            F.min("key").alias("first_key"), F.min(F.coalesce("doc_id", F.lit(-(2 ** 63)))).alias("first_id"),
        )
        # The range's first document may reach past the middle: the cut is then just before it.
        .select(F.col("source").alias("s"), F.coalesce(F.col("cut.key"), F.col("first_key")).alias("cut_key"),
                F.coalesce(F.col("cut.id"), F.lit(None).cast("long")).alias("cut_id"))
    )
    return (
        plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
        .select("source", "source_size", "target", F.col("epochs").cast("long").alias("epochs"), "cut_key", "cut_id")
    )


def _copies(keyed: DataFrame, plan: DataFrame, names: dict[str, str]) -> tuple[DataFrame, "F.Column"]:
    p = plan.select(*[F.col(c).alias(names[c]) for c in plan.columns])
    id_ = F.coalesce(F.col("doc_id"), F.lit(-(2 ** 63)))
    k, cut, cid = F.col(names["key"]), F.col(names["cut_key"]), F.col(names["cut_id"])
    fraction = (k < cut) | ((k == cut) & (id_ <= cid))
    joined = keyed.join(p, keyed["source"].eqNullSafe(p[names["source"]]))
    return joined, F.col(names["epochs"]) + F.coalesce(fraction, F.lit(False)).cast("long")


_PLAN = ("source", "source_size", "target", "epochs", "cut_key", "cut_id")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
        key(F.col("doc_id"), F.col("text")).alias("key"),
    )


def mixing_table(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    store = Store(docs.sparkSession, "mixing")
    rows = store.put(_keyed(docs), "rows")
    plan = store.put(mixing_plan(rows), "plan")
    names = {c: f"plan_{c}" for c in _PLAN} | {"key": "key"}
    joined, copies = _copies(rows, plan, names)
    return joined.select(
        "doc_id", "size", F.col("plan_source_size").alias("source_size"), F.col("plan_target").alias("target"),
        (F.col("size") * copies).alias("taken"),
    )


def mix_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; texts are not shuffled."""
    store = Store(docs.sparkSession, "mixing")
    plan = store.put(mixing_plan(store.put(_keyed(docs), "rows")), "plan")
    names = {c: fresh(docs, c) for c in (*_PLAN, "key")}
    keyed = docs.withColumn(names["key"], key(F.col("doc_id"), F.col("text")))
    joined, copies = _copies(keyed, plan, names)
    some = F.when(F.col("text").rlike(rf"[^{SPACE_CLASS}]"), copies).otherwise(0).cast("int")
    nth = fresh(docs, "nth")
    return (
        joined.withColumn(nth, F.explode(F.array_repeat(F.lit(1), some)))
        .select(*[joined[c] for c in docs.columns])
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_table(table(spark, sf_dir, "documents"))


#: A word is a maximal run of other characters than white space.
OP9_SQL = rf"""
with d as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as bigint) as size,
         case when length(text) > 0
              then 1 - 0.5::double * ((length(text) - length(regexp_replace(text, '[!-@\[-`{{-~]+', '', 'g')))::double / length(text)::double)
              else 0.5::double end as w,
         (cast(('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 12)) as bigint)::double + 0.5::double)
           / 281474976710656::double as u
  from documents),
k as (select *, -ln(u) / w as key from d),
s as (select source, cast(sum(size) as bigint) as source_size from k group by source),
t as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint] as weight,
             {MOST} * source_size as cap from s),
f as (select *, cast(sum(source_size) over () - coalesce(sum(cap) over b, 0) as double)
               / cast(sum(weight) over () - coalesce(sum(weight) over b, 0) as double) as level
      from t window b as (order by cap::double / weight::double, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select min(level) as level from (
        select level from f where level * weight <= cap order by cap::double / weight::double, source nulls last limit 1)),
g as (select source, source_size, least(cap::double, coalesce((select level from l) * weight, cap::double)) as target from t),
e as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from g),
r as (select *, target - epochs * source_size as rest from e),
m as (select k.*, r.source_size, r.target, r.epochs, r.rest,
             sum(k.size) over (partition by k.source order by k.key, k.doc_id) as after,
             sum(k.size) over (partition by k.source, k.key, k.doc_id) as own
      from k join r on k.source is not distinct from r.source)
select doc_id, size, source_size, target,
       cast(size * (epochs + case when after - own / 2.0 <= rest then 1 else 0 end) as bigint) as taken
from m
"""
