"""Benchmark decontamination by a BM25 index of test items, queried with every training passage.

Index. Words are runs of other characters than white space and ASCII punctuation, in small letters. An
item's impact for a word is its BM25 weight divided by the item's score for itself, so that a
passage with all of an item's words scores 1. The number of items, their mean length and how many of them
hold a word are those of the whole benchmark, counted by Spark. Postings lie in blocks of ``BLOCK``
items, and for each word and block the largest impact is kept.

Search. A passage is two neighbouring segments of a text, a segment being as long as the longest
item of its class of lengths, so that an item that a text holds lies whole within some passage. As in block-max WAND, words
split into a non-essential part, common words that give any item at most half the threshold
together, and the others; a block is skipped when the largest impacts of a passage's
essential words cannot bring one of its items to the threshold. The items of the other blocks are
scored in full, and every item at ``LEAST`` or above is a candidate. No candidate is left out.

Verification. An item splits into question (all but its last sentence) and answer (the last sentence),
five words at least each. A candidate counts if the passage holds at least ``OVERLAP`` of the
five-word shingles of both.

The index travels to the tasks in shards of at most ``SHARD_WORDS`` words of items of one class (or one item
that is longer), one at a time: the rows that a shard finds are written before the next is loaded. No score
depends on how items are dealt to shards. Texts are read once for each shard, which is once for each
class in a benchmark of usual size. Bounds of passages are computed for ``CELLS`` pairs of segment
and block at a time.

Defined cases: a null or empty text or item matches nothing; an item of fewer than five words
matches where its words stand in sequence; repeated rows give a row each; empty tables give an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Store, table
from .words import SPACE, chunks, shingles, word_hashes, word_spans

WIDTH = 5
LEAST = 0.5
OVERLAP = 0.75
BLOCK = 16
SHARD_WORDS = 500_000
K1, B = 1.2, 0.75
#: Most words of an item of each class of lengths but the last.
LENGTHS = (64, 512, 4096)
CELLS = 1 << 20

_BETWEEN = SPACE.copy()
_BETWEEN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def hashes_of(text: str) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _BETWEEN)
    return word_hashes(data, starts, ends)


def question_and_answer(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of an item's question and answer."""
    words = hashes_of(text)
    ends = [m.end() for m in re.finditer(r"[.!?][\"')\]]*\s+", text.rstrip())]
    last = len(hashes_of(text[ends[-1]:])) if ends else len(words) // 2
    last = min(max(last, WIDTH), max(len(words) - WIDTH, WIDTH))
    return np.unique(shingles(words[: max(len(words) - last, WIDTH)], WIDTH)), np.unique(shingles(words[-last:], WIDTH))


class Index:
    """The items of a shard. ``counts`` has the number of items of the benchmark that hold a word, for each word of
    the shard in the order of their hashes; ``n_items``, ``mean`` and ``segment`` are those of the benchmark too."""

    def __init__(self, items: list[tuple[int, str]], counts: np.ndarray, n_items: int, mean: float, segment: int):
        bags = [hashes_of(text) for _, text in items]
        keep = [i for i, bag in enumerate(bags) if len(bag)]
        self.ids = [items[i][0] for i in keep]
        self.parts = [question_and_answer(items[i][1]) for i in keep]
        self.sizes = [len(bags[i]) for i in keep]
        self.segment = segment
        n = len(keep)
        rows = [np.unique(bags[i], return_counts=True) for i in keep]
        terms = np.concatenate([r[0] for r in rows]) if n else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(n), [len(r[0]) for r in rows])
        count = np.concatenate([r[1] for r in rows]) if n else np.zeros(0)
        self.vocabulary, term = np.unique(terms, return_inverse=True)
        df = counts
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        size = np.array(self.sizes, float)
        weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * size[item] / mean))
        own = np.bincount(item, weights=weight, minlength=n)
        impact = weight / own[item]
        order = np.lexsort((item, term))
        self.item, self.impact, self.start = item[order], impact[order], np.searchsorted(term[order], np.arange(len(df) + 1))
        # Non-essential words: the most common ones, while no item gets more than half the threshold from them.
        rank = np.argsort(np.argsort(-df, kind="stable"), kind="stable")
        by_rank = np.lexsort((rank[term], item))
        running = np.cumsum(impact[by_rank]) - np.repeat(np.cumsum(np.bincount(item, weights=impact, minlength=n)) - 1, np.bincount(item, minlength=n)) if n else np.zeros(0)
        over = rank[term][by_rank][running > LEAST / 2]
        first = over.min() if len(over) else len(df)
        self.essential = rank >= first
        common = np.bincount(item, weights=impact * ~self.essential[term], minlength=n)
        # For each essential word its blocks with the largest impact; the least that a block must reach.
        kept = self.essential[term[order]]
        pair = term[order][kept].astype(np.int64) * (n // BLOCK + 1) + self.item[kept] // BLOCK
        pairs, at = np.unique(pair, return_inverse=True)
        self.top = np.zeros(len(pairs))
        np.maximum.at(self.top, at, self.impact[kept])
        self.blocks = -(-n // BLOCK)
        self.block = (pairs % (n // BLOCK + 1)).astype(np.int64)
        self.block_start = np.searchsorted(pairs // (n // BLOCK + 1), np.arange(len(df) + 1))
        self.goal = np.array([LEAST - common[b * BLOCK: (b + 1) * BLOCK].max() for b in range(self.blocks)])
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def terms(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that the index has, and their numbers."""
        maybe = np.flatnonzero(self.sieve[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), max(0, len(self.vocabulary) - 1))
        right = self.vocabulary[found] == hashes[maybe]
        return maybe[right], found[right]

    def passages(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(text, first word, end, blocks) of the passages with blocks that may reach the threshold.
        ``first``: the number of each text's first word."""
        lengths = np.diff(first)
        per = -(-lengths // self.segment)
        base = np.concatenate([[0], np.cumsum(per)])
        at, term = self.terms(hashes)
        good = self.essential[term]
        at, term = at[good], term[good]
        text = np.searchsorted(first, at, "right") - 1
        segment = base[text] + (at - first[text]) // self.segment
        found = np.unique(segment * len(self.vocabulary) + term)
        segment, term = found // len(self.vocabulary), found % len(self.vocabulary)
        of, step = np.repeat(np.arange(len(lengths)), per), max(1, CELLS // self.blocks)
        for low in range(0, int(base[-1]), step):
            # The segments from low to high, and one more as the last one's neighbour.
            high = min(low + step, int(base[-1]))
            last = min(high + 1, int(base[-1]))
            these = slice(*np.searchsorted(segment, [low, last]))
            many = self.block_start[term[these] + 1] - self.block_start[term[these]]
            entry = np.repeat(self.block_start[term[these]] - np.cumsum(many) + many, many) + np.arange(many.sum())
            bound = np.bincount(np.repeat(segment[these] - low, many) * self.blocks + self.block[entry], weights=self.top[entry],
                                minlength=(last - low) * self.blocks).reshape(-1, self.blocks)
            joined, own = bound.copy(), of[low:last]
            joined[:-1] += np.where((own[1:] == own[:-1])[:, None], bound[1:], 0)
            reach = joined[: high - low] >= self.goal - 1e-9
            for s in low + np.flatnonzero(reach.any(axis=1)):
                text = int(of[s])
                a = int(first[text] + (s - base[text]) * self.segment)
                yield text, a, int(min(first[text + 1], a + 2 * self.segment)), np.flatnonzero(reach[s - low])

    def matches(self, words: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, float, float, float]]:
        """(item, score, question, answer) of the items of ``blocks`` that a passage holds."""
        _, term = self.terms(words)
        term = np.unique(term)
        many = self.start[term + 1] - self.start[term]
        entry = np.repeat(self.start[term] - np.cumsum(many) + many, many) + np.arange(many.sum())
        score = np.bincount(self.item[entry], weights=self.impact[entry], minlength=len(self.ids))
        held = None
        for i in np.flatnonzero(score >= LEAST - 1e-9):
            if i // BLOCK not in blocks:
                continue
            if self.sizes[i] < WIDTH:
                own = shingles(words, self.sizes[i]) if len(words) >= self.sizes[i] else words[:0]
            else:
                own = held = shingles(words, WIDTH) if held is None else held
            parts = [np.isin(p, own).mean() for p in self.parts[i]]
            if min(parts) >= OVERLAP:
                yield int(i), float(score[i]), float(parts[0]), float(parts[1])

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question, answer): the best passage for each text and item."""
        if not self.ids:
            return
        for base, data, bounds in chunks(texts):
            starts, ends, first = word_spans(data, bounds, _BETWEEN)
            hashes = word_hashes(data, starts, ends)
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for text, a, b, blocks in self.passages(hashes, first):
                for item, *found in self.matches(hashes[a:b], blocks):
                    best[text, item] = max(best.get((text, item), (0.0, 0.0, 0.0)), tuple(found))
            for (text, item), found in sorted(best.items()):
                yield base + text, self.ids[item], *found


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """size and the different words of each item."""
    for batch in batches:
        bags = [hashes_of(t.as_py()) for t in batch.column("text")]
        words = [np.unique(bag).view(np.int64).tolist() for bag in bags]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("text"), pa.array([len(b) for b in bags], pa.int64()), pa.array(words, pa.list_(pa.int64()))],
            ["item_id", "text", "size", "words"])


def indexes(benchmark: DataFrame, store: Store) -> Iterator[Index]:
    """An index for each shard of ``benchmark`` (item_id, text), made when it is asked for."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = store.put(items.mapInArrow(_item_words, "item_id long, text string, size long, words array<long>").where("size > 0"), "items")
    counts = store.put(items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "words")
    whole = items.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
    class_ = sum((F.col("size") > most).cast("int") for most in LENGTHS)
    classes = items.groupBy(class_.alias("class")).agg(F.sum("size").alias("words"), F.max("size").alias("longest"))
    for row in classes.orderBy("class").collect():
        shards = -(-row["words"] // SHARD_WORDS)
        for shard in range(shards):
            part = items.where((class_ == row["class"]) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard))
            own = part.select(F.explode("words").alias("word")).distinct().join(counts, "word").collect()
            texts = part.select("item_id", "text").orderBy("item_id", "text").collect()
            words = np.array([(r["word"], r["n"]) for r in own], np.int64).reshape(-1, 2)
            order = np.argsort(words[:, 0].view(np.uint64))
            yield Index([(r["item_id"], r["text"]) for r in texts], words[order, 1], whole["n"], whole["mean"], row["longest"])


SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` and item that it holds: doc_id, item_id, score and both overlaps."""
    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(index(batch.column("text")))
                ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([f[1] for f in found], pa.int64()),
                     *(pa.array([f[k] for f in found], pa.float64()) for k in (2, 3, 4))],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
        return run

    store = Store(docs.sparkSession, "decontamination")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for k, index in enumerate(indexes(benchmark, store)):
        out = out.unionByName(store.put(narrow.mapInArrow(search(index), SCHEMA), f"found{k}"))
    return out


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    def drop(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in index(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))
        return run

    store, shards = Store(docs.sparkSession, "decontamination"), indexes(benchmark, Store(docs.sparkSession, "benchmark"))
    # The last shard's rows needn't be written here; whoever asked for them does.
    index, k = next(shards, None), 0
    while index is not None:
        kept, index = docs.mapInArrow(drop(index), docs.schema), next(shards, None)
        if index is not None:
            docs = store.put(kept, f"kept{k}")
            if k:
                store.drop(f"kept{k - 1}")
            k += 1
        else:
            docs = kept
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
