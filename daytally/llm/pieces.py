"""Encoding and decoding with a SentencePiece vocabulary of the merge type.

A text is escaped (blanks become ``MARK``, one of which is put first) and cut into symbols of one character.
An agenda holds the adjacent pairs that form a piece, the best score first and of equal scores the
leftmost; the top pair is merged, and the pairs with its new neighbours join the agenda, until none is
left. Symbols that are no piece become their UTF-8 bytes.

Where no piece of the vocabulary can lie across a place, as between a letter and a comma, nothing is merged
across it. So a text is cut at such places, by classes of characters found in the pieces themselves; each
stretch has an agenda of its own, with the same result, and the ids of the latest stretches are kept. The
agendas of short stretches are rows of one array of ranks, from which all take their best pair
at a time; a longer stretch has a heap.

``encode_table`` runs it in Arrow batches, and has the sentencepiece library encode and decode the same
texts beside it; ``agrees`` tells whether ids and decoded text are equal.

The vocabulary's file is read once, by the driver, and its bytes (``LARGEST`` at most) go with the task.

Defined cases: a null text counts as empty, and an empty text has the end id only; bytes that aren't UTF-8
count as U+FFFD; texts are encoded whole, however long; repeated rows give equal rows; a null doc_id is
an id like any other; an empty table gives an empty result. Vocabularies of another type, with rewriting
rules, with pieces given by hand or without byte pieces are refused.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

MARK = "▁"
#: Bytes of a vocabulary's file; characters of a short stretch, how many of them are merged at a time, and how many are kept.
LARGEST, SHORT, TOGETHER, KEPT = 64 << 20, 48, 4096, 1 << 18
#: Characters that the library gets at once, one whole text at least.
BLOCK = 1 << 20
#: Fixed values of the format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT = " ⁇ "

#: An entry of a heap is the rank of a pair's score above these bits and its place below.
PLACE = 40
#: Rank of what is no pair.
NEVER = 2 ** 31 - 1
SPREAD = np.uint64(0x9E3779B97F4A7C15)

# Each byte that is part of no character becomes a U+FFFD of its own.
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


def stretches(pieces: list[str]) -> re.Pattern:
    """Cuts a text into stretches with no merge across their bounds: characters that no piece joins to
    others; letters, and what follows a letter in some piece, with whatever may stand before them."""
    joined = [p for p in pieces if len(p) > 1]
    pairs = {pair for p in joined for pair in zip(p, p[1:])}
    characters = set("".join(joined))
    letters = {c for c in characters if c.isalpha()}
    while more := {b for a, b in pairs if a in letters} - letters:
        letters |= more
    others = characters - letters
    group = {name: "".join(re.escape(c) for c in sorted(chars)) for name, chars in (("l", letters), ("o", others), ("a", characters))}
    parts = [f"[{group['o']}]+"] if others else []
    if letters:
        parts.insert(0, f"[{group['o']}]*[{group['l']}]+" if others else f"[{group['l']}]+")
    parts.append(f"[^{group['a']}]+" if characters else "(?s:.+)")
    return re.compile("|".join(parts))


class Vocabulary:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as format_

        proto = format_.ModelProto()
        proto.ParseFromString(model)
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        self.kinds = [p.type for p in proto.pieces]
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("not a merge-type vocabulary with byte pieces and leading blanks")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a vocabulary with rewriting rules or pieces given by hand")
        self.first = MARK if rules.add_dummy_prefix else ""
        normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        self.ids = {piece: i for i, piece, _ in normal}
        levels = {score: rank for rank, score in enumerate(sorted({score for _, _, score in normal}, reverse=True), 1)}
        self.ranks = {piece: levels[score] << PLACE for _, piece, score in normal if len(piece) > 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.stretches = stretches(list(self.ids))
        # No piece goes on after a blank, and a text begins with one.
        self.words = bool(self.first) and not any(MARK in piece.lstrip(MARK) for piece in self.ids)
        self._pair_table()
        self.end = next(i for i, p in enumerate(proto.pieces) if p.piece == trainer.eos_piece)
        of_byte = {i: bytes([b]) for b, i in self.bytes.items()}
        surfaces = {CONTROL: lambda p: "", UNKNOWN: lambda p: UNKNOWN_TEXT, NORMAL: lambda p: p.piece.replace(MARK, " ")}
        self.surfaces = [of_byte[i] if p.type == BYTE else surfaces[p.type](p).encode() for i, p in enumerate(proto.pieces)]
        self.names = [str(i) for i in range(len(self.kinds))]
        # Ids of a stretch as bytes, 4 for each.
        self.kept: dict[str, bytes] = {}
        self.kept_before: dict[str, bytes] = {}

    def _pair_table(self) -> None:
        """All pairs of symbols that form a piece, with the piece's rank and id. A
        symbol is a piece, a byte, or a character of pieces that is none itself; any other one is ``nothing``."""
        numbers = dict(self.ids)
        for c in sorted({c for piece in self.ids for c in piece}):
            numbers.setdefault(c, len(self.kinds) + len(numbers))
        self.nothing = max(numbers.values(), default=0) + 1
        found = sorted(
            (left * (self.nothing + 1) + right, self.ranks[piece] >> PLACE, self.ids[piece])
            for piece in self.ranks for cut in range(1, len(piece))
            if (left := numbers.get(piece[:cut])) is not None and (right := numbers.get(piece[cut:])) is not None)
        # A hash table in arrays: each pair lies at its place or in one of the next ones, before an empty one.
        self.shift = 64 - max(4, (4 * len(found)).bit_length())
        size = 1 << 64 - self.shift
        self.pairs = np.full(size + len(found) + 1, -1, np.int64)
        self.pair_ranks, self.pair_ids = np.full(len(self.pairs), NEVER, np.int32), np.zeros(len(self.pairs), np.int32)
        wanted = np.array([pair for pair, _, _ in found], np.int64)
        for (pair, rank, piece), at in zip(found, self._places(wanted).tolist()):
            while self.pairs[at] >= 0:
                at += 1
            self.pairs[at], self.pair_ranks[at], self.pair_ids[at] = pair, rank, piece
        self.characters = np.full(0x110000, self.nothing, np.int32)
        self.characters[:128] = [self.bytes[c] for c in range(128)]  # where one byte stands for a character
        for symbol, number in numbers.items():
            if len(symbol) == 1:
                self.characters[ord(symbol)] = number

    def _places(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * SPREAD) >> np.uint64(self.shift)).astype(np.int64)

    def paired(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that each pair of symbols forms."""
        wanted = left * np.int64(self.nothing + 1) + right
        at = self._places(wanted)
        seen = self.pairs[at]
        ranks, ids = np.where(seen == wanted, self.pair_ranks[at], NEVER), self.pair_ids[at]
        open_ = np.flatnonzero((seen != wanted) & (seen >= 0))
        while len(open_):
            at[open_] += 1
            here = at[open_]
            seen = self.pairs[here]
            same = seen == wanted[open_]
            ranks[open_[same]], ids[open_[same]] = self.pair_ranks[here[same]], self.pair_ids[here[same]]
            open_ = open_[~same & (seen >= 0)]
        return ranks, ids

    def merged_together(self, short: list[str]) -> list[bytes]:
        """The ids of each of many stretches, in arrays with a row for each and a last column for nothing."""
        lengths = np.array([len(s) for s in short])
        n, width = len(short), int(lengths.max()) + 1
        there = np.arange(width) < lengths[:, None]
        symbols = np.full((n, width), self.nothing, np.int32)
        symbols[there] = self.characters[np.frombuffer("".join(short).encode("utf-32-le"), np.uint32)]
        agenda, into = np.full((n, width), NEVER, np.int32), np.zeros((n, width), np.int32)
        beside = there[:, 1:]
        agenda[:, :-1][beside], into[:, :-1][beside] = self.paired(symbols[:, :-1][beside], symbols[:, 1:][beside])
        right, left = np.tile(np.arange(1, width + 1), (n, 1)), np.tile(np.arange(-1, width - 1), (n, 1))
        symbols, entries, into, right, left = (x.reshape(-1) for x in (symbols, agenda, into, right, left))
        rows = np.arange(n)
        while len(rows):
            at = agenda[rows].argmin(1)  # of equal ranks the first
            here = rows * width + at
            some = entries[here] < NEVER
            rows, at, here = rows[some], at[some], here[some]
            first = rows * width
            gone = first + right[here]
            symbols[here], right[here] = into[here], right[gone]
            symbols[gone], entries[gone] = -1, NEVER
            after = first + np.minimum(right[here], width - 1)
            left[after] = at
            entries[here], into[here] = self.paired(symbols[here], symbols[after])
            has = left[here] >= 0
            before = (first + left[here])[has]
            entries[before], into[before] = self.paired(symbols[before], symbols[here][has])
        symbols = symbols.reshape(n, width)
        stay = there & (symbols >= 0)
        flat, ends = symbols[stay].tobytes(), np.cumsum(4 * stay.sum(1)).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero((there & (symbols >= len(self.kinds))).any(1)):
            out[i] = self.merged(short[i])  # has symbols that become bytes
        return out

    def merged(self, stretch: str) -> bytes:
        """The ids of one stretch."""
        rank_of = self.ranks.get
        symbols, count = list(stretch), len(stretch)
        agenda = [rank + i for i, pair in enumerate(map(add, symbols, symbols[1:])) if (rank := rank_of(pair))]
        if agenda:
            heapq.heapify(agenda)
            left, right = list(range(-1, count - 1)), list(range(1, count + 1))
        while agenda:
            top = heapq.heappop(agenda)
            at = top & ((1 << PLACE) - 1)
            # A symbol that has grown or gone since makes the entry void.
            if not symbols[at] or (beside := right[at]) == count:
                continue
            pair = symbols[at] + symbols[beside]
            if rank_of(pair, 0) != top - at:
                continue
            symbols[at], symbols[beside] = pair, ""
            right[at] = after = right[beside]
            if after < count:
                left[after] = at
                if rank := rank_of(pair + symbols[after]):
                    heapq.heappush(agenda, rank + at)
            before = left[at]
            if before >= 0 and (rank := rank_of(symbols[before] + pair)):
                heapq.heappush(agenda, rank + before)
        out: list[int] = []
        for symbol in symbols:
            if symbol in self.ids:
                out.append(self.ids[symbol])
            elif symbol:
                out.extend(self.bytes[b] for b in symbol.encode())
        return np.array(out, np.int32).tobytes()

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """The ids of all ``wanted`` stretches, which ``kept`` lacks; short ones are kept. What was used
        since the one before last ``KEPT`` were new is still at hand."""
        found = {s: ids for s in wanted if (ids := self.kept_before.get(s)) is not None}
        new = sorted(wanted - found.keys(), key=len)
        n_short = bisect_right(new, SHORT, key=len)
        for at in range(0, n_short, TOGETHER):
            short = new[at: min(at + TOGETHER, n_short)]
            found.update(zip(short, self.merged_together(short)))
        self.kept.update(found)
        return found | {s: self.merged(s) for s in new[n_short:]}

    def _ids(self, wanted: list[str]) -> list[bytes]:
        """The ids of each of ``wanted`` stretches."""
        found = list(map(self.kept.get, wanted))
        lacking = {s for s, ids in zip(wanted, found) if ids is None}
        if lacking:
            new = self._learn(lacking)
            found = [ids or new[s] for s, ids in zip(wanted, found)]
        return found

    def _plain(self, text: str) -> bool:
        """Whether a text has single blanks only and between words, so that its words are its stretches (see ``words``)."""
        return self.words and bool(text) and text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text

    def _of_words(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of plain texts: different words are looked up once and then dealt out in arrays."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = split.flatten().dictionary_encode()
        ids = self._ids([MARK + w for w in words.dictionary.to_pylist()])
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(ids), np.int32)
        place = words.indices.to_numpy(zero_copy_only=False)
        many = sizes[place]
        ends = np.cumsum(many)
        dealt = flat[np.repeat(starts[place] - ends + many, many) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy(zero_copy_only=False)].tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield dealt[a:b].tolist()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, the end id last."""
        if len(self.kept) > KEPT:
            self.kept, self.kept_before = {}, self.kept
        plain = [self._plain(text) for text in texts]
        words = self._of_words([t for t, p in zip(texts, plain) if p]) if any(plain) else iter(())
        out = []
        for text, is_plain in zip(texts, plain):
            if is_plain:
                ids = next(words)
            else:
                cut = self.stretches.findall(self.first + text.replace(" ", MARK)) if text else []
                ids = np.frombuffer(b"".join(self._ids(cut)), np.int32).tolist()
            ids.append(self.end)
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; the mark put first goes."""
        text = b"".join([self.surfaces[i] for i in ids]).decode("utf-8", "each_byte")
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        drop = self.first and first is not None and self.kinds[first] == NORMAL and text.startswith(" ")
        return text[1:] if drop else text

    def digests(self, ids: list[int], text: str) -> tuple[str, str]:
        joined = " ".join([self.names[i] for i in ids])
        return hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@functools.lru_cache(maxsize=2)
def loaded(model: bytes):
    """The vocabulary and the library's processor; kept by a Python worker from task to task."""
    import sentencepiece

    return Vocabulary(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        model = file.read(LARGEST + 1)
    if len(model) > LARGEST:
        raise ValueError(f"{path} has more than {LARGEST} bytes")
    return model


def blocks(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a binary column in runs of about ``BLOCK`` bytes."""
    block, size = [], 0
    for cell in column:
        text = (cell.as_py() or b"").decode("utf-8", "replace")
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def encode_table(docs: DataFrame, model: bytes) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, library = loaded(model)
        for batch in batches:
            rows: list[tuple] = []
            for texts in blocks(batch.column("text")):
                beside = library.encode(texts, add_eos=True, num_threads=1)
                back = library.decode(beside, num_threads=1)
                for ids, same_ids, same_text in zip(vocabulary.encode_all(texts), beside, back):
                    decoded = vocabulary.decode(ids)
                    rows.append((len(ids), *vocabulary.digests(ids, decoded), ids == same_ids and decoded == same_text))
            n, of_ids, of_text, agrees = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), pa.array(agrees, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_table(table(spark, sf_dir, "documents"), read_model(public_tokenizers.path("piece_bpe_32k.model")))
