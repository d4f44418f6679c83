"""Toxicity by weak supervision.

1. Voters. Lexicon voters look for a stem, the first 4, 5 or 6 letters of a word or a whole word: a few
   fixed ones, and those that toxic training texts hold much more often than others.
   Pattern voters look at shouting, exclamation marks and signs. The label of a training row is one more
   voter, since labels may be wrong too.
2. A generative model with one hidden class per text gives each voter a rate per class and finds
   them by expectation maximisation. Voters that still agree once the class is known (a stem and its
   longer form) are correlated: they form a cluster that shares one vote.
3. A linear classifier (logistic regression) is trained on the posterior classes, and scores every text
   from its stems and patterns. Nothing else of a row is an input of its score.

Texts are read by pieces that end at white space, so a worker holds one batch of rows and one piece.

Training rows are labelled rows whose crc32 of the doc_id as text is not divisible by 5, at most
``POSITIVES`` toxic and ``NEGATIVES`` other ones, taken by a hash of their id; this bounds the fit.
Weights bring their share back to that of all training rows. Scoring covers all rows and whole texts.

Defined cases: a null or empty text has no stem and gets a low score; repeated rows get equal scores;
a row without label is not trained on; a null doc_id counts as the empty text in crc32; empty tables
give empty results; without training rows the fixed stems alone decide.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import Store, fresh, table

POSITIVES, NEGATIVES = 4000, 8000
#: Stems that are counted, and stems that become voters.
CANDIDATES, VOTERS = 4096, 256
FOLDS = 5
CORRELATED = 0.25
#: Characters of a text that are looked at together, and the next white space after them.
PIECE = 1 << 16

#: Common insults in English, German, French and Spanish.
SEEDS = (
    "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb imbecile jerk bastard filth vermin "
    "dummkopf arschloch abschaum trottel depp widerlich connard salaud ordure abruti minable crétin "
    "estúpido imbécil basura escoria idiota asqueroso"
).split()

_WORDS, _SPACE = re.compile(r"[^\W\d_]+"), re.compile(r"\s")
_CAPITALS, _SIGNS = re.compile(r"[A-Z]+"), re.compile(r"[#$%&*@]+")


def pieces(text: str | None) -> Iterator[str]:
    """The whole of a text, cut at white space."""
    text, at = text or "", 0
    while at < len(text):
        space = _SPACE.search(text, at + PIECE)
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end


def spaced(text: str) -> str:
    """The words of a text in small letters, a blank before and after each."""
    return f" {' '.join(_WORDS.findall(text.lower()))} "


def stems(text: str | None) -> set[str]:
    """`` abcd`` stands for words that begin so, `` abcd `` for the word."""
    found = set()
    for piece in pieces(text):
        for word in set(_WORDS.findall(piece.lower())):
            if len(word) >= 4:
                found.update((f" {word[:4]}", f" {word[:5]}", f" {word[:6]}"))
                if len(word) <= 12:
                    found.add(f" {word} ")
    return found


def patterns(text: str | None) -> list[float]:
    """Shouting, exclamation marks, signs: each 0 or 1."""
    capitals = marks = signs = 0
    for piece in pieces(text):
        capitals += len(piece) - len(_CAPITALS.sub("", piece))
        marks += piece.count("!")
        signs += len(piece) - len(_SIGNS.sub("", piece))
    n = max(1, len(text or ""))
    return [float(capitals / n > 0.3), float(marks / n > 0.01), float(signs / n > 0.05)]


class Lexicon:
    """Counts the stems of a list in a text, in one pass whatever the list's length."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.words = words
        self.found = ahocorasick.Automaton()
        for i, word in enumerate(words):
            self.found.add_word(word, i)
        if words:
            self.found.make_automaton()

    def __call__(self, text: str | None) -> Counter:
        counts: Counter = Counter()
        if self.words:
            for piece in pieces(text):
                counts.update(i for _, i in self.found.iter(spaced(piece)))
        return counts


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch, one at a time."""
    for cell in batch.column(name):
        yield cell.as_py()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Rows (text, toxic, rank) to learn from, and the share of toxic ones among all there are."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    rank = F.xxhash64("doc_id", F.lit(6))
    chosen = [known.where(f"toxic {test} 1").withColumn("rank", rank).orderBy("rank", "doc_id").limit(most)
              for test, most in (("=", POSITIVES), ("<>", NEGATIVES))]
    picked = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "labelled")  # bounded by the two limits
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("labelled"))
    return rows.select("text", (F.col("toxic") == 1).cast("int").alias("toxic"), "rank"), share


def _toxic_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = Counter(s for text in texts(batch) for s in stems(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["stem", "n"])


def choose_stems(rows: DataFrame) -> list[str]:
    """Stems that toxic rows hold far more often: the fixed ones, then by how well they tell."""
    per_class = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    yes, no = per_class.get(1, 0), per_class.get(0, 0)
    fixed = [f" {s}" for s in SEEDS]
    if not yes:
        return fixed
    least = max(3, yes // 200)
    counted = (
        rows.where("toxic = 1").select("text").mapInArrow(_toxic_stems, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least).orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()
    )
    names = [r["stem"] for r in counted]

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(names)
        for batch in batches:
            seen = Counter(i for text in texts(batch) for i in lexicon(text).keys())
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["i", "n"])

    among = rows.where("toxic = 0").select("text").mapInArrow(others, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    clean = {r["i"]: r["n"] for r in among.collect()}
    p = np.array([(r["n"] + 0.5) / (yes + 1) for r in counted])
    q = np.array([(clean.get(i, 0) + 0.5) / (no + 1) for i in range(len(names))])
    gain = np.where(p > 4 * q, p * np.log(p / q) + (1 - p) * np.log((1 - p) / (1 - q)), -1)
    best = [names[i] for i in np.argsort(-gain, kind="stable") if gain[i] > 0]
    return list(dict.fromkeys(fixed + best))[:VOTERS]


def _features(counts: Counter, text: str | None, n: int) -> np.ndarray:
    """Stems that occur, patterns, and how many stems occur in all."""
    x = np.zeros(n + 4)
    x[list(counts)] = 1
    x[n: n + 3] = patterns(text)
    x[n + 3] = np.log1p(sum(counts.values()))
    return x


def label_model(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Probability of class 1 for each row of 0/1 ``votes``; ``labels`` are a voter of their own
    and give the start."""
    seen = np.column_stack([votes, labels])
    post = np.where(labels == 1, 0.95, 0.05)
    share = np.ones(seen.shape[1])
    for turn in range(rounds):
        w1, w0 = weights * post, weights * (1 - post)
        r1, r0 = (w1 @ seen + 0.5) / (w1.sum() + 1), (w0 @ seen + 0.5) / (w0.sum() + 1)
        if turn == 3:
            share = clusters(seen, post, weights, r1, r0)
        prior = np.clip(w1.sum() / weights.sum(), 1e-3, 1 - 1e-3)
        odds = np.log(prior / (1 - prior)) + (
            seen * (np.log(r1) - np.log(r0)) + (1 - seen) * (np.log1p(-r1) - np.log1p(-r0))) @ share
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post


def clusters(seen: np.ndarray, post: np.ndarray, weights: np.ndarray, r1: np.ndarray, r0: np.ndarray) -> np.ndarray:
    """The part of a vote that each voter has: one shared by the voters correlated given the class."""
    centred = seen - post[:, None] * r1 - (1 - post)[:, None] * r0
    cov = (centred * weights[:, None]).T @ centred
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    tied = np.abs(cov / dev / dev[:, None]) > CORRELATED
    tied[-1], tied[:, -1] = False, False  # the labels stand alone
    group = np.arange(len(dev))
    for i in range(len(dev)):
        for j in np.flatnonzero(tied[i, :i]):
            group[group == group[i]] = group[j]
    return 1 / np.bincount(group, minlength=len(dev))[group]


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft classes, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    cost = np.full(x.shape[1], ridge)
    cost[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weights * (p - y)) + cost * beta
        hess = (x * (weights * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(cost)
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """The stems and the classifier's weights."""
    rows, share = training_rows(docs, labels)
    store = Store(docs.sparkSession, "toxicity")
    rows = store.put(rows, "training")
    names = choose_stems(rows)
    n = len(names)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(names)
        for batch in batches:
            x = [_features(lexicon(t), t, n).astype("float32").tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("toxic"), pa.array(x, pa.binary())], ["rank", "toxic", "x"])

    # At most POSITIVES + NEGATIVES distinct ids, with VOTERS + 4 numbers each.
    got = rows.mapInArrow(vectors, "rank long, toxic int, x binary").dropDuplicates(["rank"]).orderBy("rank").collect()
    store.drop("training")
    if not any(r["toxic"] for r in got):
        return names, np.array([4.0] * n + [0.0] * 4 + [-2.0])
    x = np.stack([np.frombuffer(r["x"], "float32") for r in got]).astype(float)
    y = np.array([r["toxic"] for r in got], float)
    share = min(max(share, 1e-3), 1 - 1e-3)
    weights = np.where(y == 1, share / y.mean(), (1 - share) / max(1e-9, 1 - y.mean())) if y.mean() < 1 else np.ones(len(y))
    post = label_model(x[:, : n + 3], y, weights)
    return names, logistic(x, post, weights)


def scored(rows: DataFrame, model: tuple[list[str], np.ndarray], name: str, drop: bool = False) -> DataFrame:
    """``rows`` with the score of their text as the column ``name``; with ``drop``, without the text."""
    names, beta = model
    kept = [c for c in rows.columns if not (drop and c == "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(names)
        for batch in batches:
            odds = np.array([_features(lexicon(t), t, len(names)) @ beta[:-1] + beta[-1] for t in texts(batch)], float)
            scores = pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), scores], [*kept, name])

    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(name, T.DoubleType())])
    return rows.mapInArrow(run, schema)


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    rows = scored(rows, fit(docs, labels), "score", drop=True)
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    score = fresh(docs, "score")
    return scored(docs, fit(docs, labels), score).where(F.col(score) < 0.5).drop(score)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
