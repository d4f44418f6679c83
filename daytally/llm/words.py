"""Words and shingles of many texts at once, as 64-bit hashes, in numpy inside tasks.

Words are maximal runs of other bytes than white space (blank, tab to carriage return) with A-Z
lower-cased. Texts are taken in pieces of about ``CHUNK`` bytes, one whole text at least, so
that memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)


def _space() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def _codes() -> np.ndarray:
    """A random number for each byte; capital and small letters share one."""
    out = np.random.default_rng(20_24).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
    out[65:91] = out[97:123]
    return out


SPACE, CODES = _space(), _codes()
_powers = {b: np.ones(1, np.uint64) for b in (_BASE, _UNBASE)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, 2 * CHUNK), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number's bits spread over all 64."""
    x = x + MIX[0]
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and, for each text, the number of its first word; ``offsets`` are the texts'
    bounds in ``data`` and ``between`` tells the bytes that words don't hold."""
    n = len(data)
    space = between[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    if n:
        first[0] = last[-1] = True
        first[1:], last[:-1] = space[:-1], space[1:]
        bounds = offsets[(offsets > 0) & (offsets < n)]
        first[bounds], last[bounds - 1] = True, True
    starts, ends = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * _power(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_UNBASE, len(data) + 1)[starts])


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, bounds) of runs of texts; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    _, bounds, data = texts.buffers()
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        yield i, data[at[i]: at[j]], at[i: j + 1] - at[i]
        i = j


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of all words if there are fewer; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(n, width)
    out = np.full(n - size + 1, size, np.uint64) * MIX[2]
    for k in range(size):
        out = mixed(out + hashes[k: n - size + 1 + k])
    return out


def text_shingles(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    for _, data, bounds in chunks(texts):
        starts, ends, first = word_spans(data, bounds)
        hashes = word_hashes(data, starts, ends)
        runs = shingles(hashes, width)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(runs[a: b - width + 1] if b - a >= width else shingles(hashes[a:b], width))
