"""Sets of word shingles as hashes, over whole Arrow columns at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed in one go (a longer text goes alone).
CHUNK = 1 << 20
WORDS = 5
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets): null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK):
    """(first, end) of runs of texts that hold ``most`` bytes at most together, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, end
        first = end


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets of the words of each text): a polynomial over the bytes of a word, mixed with its length."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1]))
    starts = np.flatnonzero(word & (~before | edge[:n]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    place = np.arange(n, dtype=np.int64)
    at = np.zeros(n, np.int64)
    at[starts] = starts
    place -= np.maximum.accumulate(at)
    place[:starts[0]] = 0
    place[~word] = 0
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE, np.uint64))
    value = _BYTE[data] * powers[place]
    value[~word] = 0
    hashes = np.add.reduceat(value, starts)
    lengths = np.add.reduceat(word.astype(np.int64), starts).astype(np.uint64)
    return mixed(hashes + lengths * _PLACE[0]), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the set, sorted, of the shingles of each text.

    Words are runs of other bytes than ASCII white space, with A-Z lower-cased. A
    text of fewer words than a shingle has all of them as its one shingle, a text
    without words none.
    """
    data, offsets = text_bytes(column)
    sets: list[np.ndarray] = []
    for first, end in chunks(offsets):
        own = offsets[first:end + 1] - offsets[first]
        w, at = _word_hashes(data[offsets[first]:offsets[end]], own)
        rolled = np.zeros(max(0, len(w) - words + 1), np.uint64)
        for i in range(words):
            rolled += w[i:len(w) - words + 1 + i] * _PLACE[i + 1]
        rolled = mixed(rolled)
        for a, b in zip(at, at[1:], strict=False):
            if b - a >= words:
                sets.append(np.unique(rolled[a:b - words + 1]))
            elif b > a:
                short = w[a:b]
                sets.append(mixed(np.array([int(b - a)], np.uint64) + (short * _PLACE[8:8 + len(short)]).sum(dtype=np.uint64)))
            else:
                sets.append(rolled[:0])
    lengths = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(lengths)))
