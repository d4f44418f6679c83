"""What each filter of a chain removes, for every order of the chain, from one pass over the texts.

Each text gets a mask: one bit for each filter that it fails. Rows are counted by part and mask
(2 ** 5 cells at most), and the rest follows from these counts:

1. ``walk`` goes through all subsets of filters in Gray-code order, so that each step toggles one
   filter. Every cell has a counter of its failing filters that are switched on; where a toggle
   brings a counter from or to zero, the cell leaves or joins the running survivors. The survivors of
   all subsets are stored.
2. A step of an order leads from the subset before it to that subset and its filter, so what it
   keeps and removes is a difference of two stored states.

The filters are ``FILTERS`` over the text itself and, last, whether a smaller doc_id has the same text
anywhere in the table. Texts are compared by their SHA-256. Rows that hold the first id of their
text are found by a join on text and id together, so a text that many rows share is no hot key.

Defined cases: a null text counts as empty, a null part as the empty string; a row without doc_id has
no smaller id and is no copy, nor does it make others copies; a fully repeated row is no copy of itself
(its id isn't smaller); an id with several labels counts as good or toxic if any of them says so; labels
without id are of no row; an empty table gives no part and so no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACE_CLASS, WORD, Store, table

#: The limits of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 3, "[#$%&*|]"
LETTERS = "ABCDE"
COUNTS = ["n", "good", "toxic"]
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails each filter that needs nothing but the text; ``words`` are its words."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * capitals > MOST_CAPITALS * F.length(text),
        text.rlike(SIGNS),
    ]


def bits(failures: list[Column], first: int = 0) -> Column:
    return sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(failures, first)), F.lit(0))


def masks(docs: DataFrame, store: Store) -> DataFrame:
    """One row per row of ``docs``: doc_id, part, mask."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", rf"[{SPACE_CLASS}]+"), ""))
    rows = store.put(
        rows.select("doc_id", "part", bits(text_failures(F.col("text"), F.col("words"))).alias("own"), F.sha2("text", 256).alias("digest")), "texts")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("own") + bits([copy], 4)).alias("mask"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """How many rows of ``masks``, and how many good and toxic ones, each part has by mask."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    counts = [F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]]
    return rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(*counts)


def walk(counts: np.ndarray) -> np.ndarray:
    """``counts`` has a row for each mask; the result has, for each subset of filters, the sums of the
    rows that fail none of them."""
    masks = np.arange(len(counts))
    failing = np.zeros(len(counts), int)
    alive = counts.sum(0)
    states = np.zeros_like(counts)
    states[0], subset = alive, 0
    for turn in range(1, len(counts)):
        bit = turn & -turn
        subset ^= bit
        holds = (masks & bit) > 0
        if subset & bit:
            alive = alive - counts[holds & (failing == 0)].sum(0)
            failing[holds] += 1
        else:
            failing[holds] -= 1
            alive = alive + counts[holds & (failing == 0)].sum(0)
        states[subset] = alive
    return states


def steps(states: np.ndarray, letters: str = LETTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for each
    step of each order."""
    out, shapley = [], dict.fromkeys(letters, 0)
    everything = len(states) - 1
    for order in itertools.permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            lost = states[before] - states[before | bit]
            failing = states[0] - states[bit]
            alone = states[everything ^ bit] - states[everything]
            shapley[letter] += int(lost[0])
            out.append(("".join(order), step, states[before | bit][0], lost[0], failing[0] - lost[0], alone[0], lost[1], lost[2]))
            before |= bit
    return [(*row, shapley[row[0][row[1] - 1]]) for row in out]


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``counts`` (part, mask, n, good, toxic) to a row for each part, order and step. A group holds
    the cells of a part, 2 ** ``len(letters)`` rows at most."""
    def report(group: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros((1 << len(letters), len(COUNTS)), np.int64)
        sums[group["mask"].to_numpy()] = group[COUNTS].to_numpy()
        rows = pd.DataFrame(steps(walk(sums), letters))
        rows.insert(0, "part", group["part"].iloc[0])
        rows.columns = [field.split()[0] for field in REPORT.split(", ")]
        return rows

    return counts.groupBy("part").applyInPandas(report, REPORT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``."""
    return audit(cells(masks(docs, Store(docs.sparkSession, "filters")), labels))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BEFORE = " + ".join(f"case when instr(filter_order, '{c}') < step then {1 << i} else 0 end" for i, c in enumerate(LETTERS))
OP11_SQL = rf"""
with recursive
w as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') as words
  from documents),
m as (
  select doc_id, part,
         case when len(words) < {LEAST_WORDS} then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) then 2 else 0 end
         + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(text) then 4 else 0 end
         + case when regexp_matches(text, '{SIGNS}') then 8 else 0 end
         + case when doc_id > min(doc_id) over (partition by text) then 16 else 0 end as mask
  from w),
l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
c as (
  select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from m left join l using (doc_id) group by part, mask),
o(filter_order, rest) as (
  select '', '{LETTERS}'
  union all
  select filter_order || substr(rest, i, 1), substr(rest, 1, i - 1) || substr(rest, i + 1)
  from o, (select unnest([1, 2, 3, 4, 5]) as i) t where i <= length(rest)),
s as (
  select filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) as bit,
         {_BEFORE} as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step) t where rest = ''),
r as (
  select part, bit, before,
         coalesce(sum(n) filter (where mask & before = 0 and mask & bit = 0), 0) as kept,
         coalesce(sum(n) filter (where mask & before = 0 and mask & bit > 0), 0) as removed,
         coalesce(sum(n) filter (where mask & before > 0 and mask & bit > 0), 0) as redundant,
         coalesce(sum(n) filter (where mask = bit), 0) as unique_fails,
         coalesce(sum(good) filter (where mask & before = 0 and mask & bit > 0), 0) as good_lost,
         coalesce(sum(toxic) filter (where mask & before = 0 and mask & bit > 0), 0) as toxic_lost
  from c, (select distinct bit, before from s) b group by part, bit, before)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from s join r using (bit, before)
"""
