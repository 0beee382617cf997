"""Distinct word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.random.RandomState(5).randint(1, 2**62, 64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Every 64-bit number to another one, its bits well spread."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


#: The code of each byte: blanks are parted from the rest before; A to Z count as a to z.
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_CODES = mix(_LOWER + _BASE)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            steps = np.full(size, _BASE, np.uint64)
            back = np.full(size, inverse, np.uint64)
            steps[0] = back[0] = 1
            _POWERS, _INVERSES = np.cumprod(steps), np.cumprod(back)
    return _POWERS[:n], _INVERSES[:n]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for every word of one text's bytes, in order; prefix sums serve all words."""
    if not len(data):
        return np.zeros(0, np.uint64)
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~_BLANK[data]
    edges = np.diff(word)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverses = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * powers[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingles(data: np.ndarray, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's ``width``-word shingles.

    With fewer words the whole sequence is one shingle; without words none.
    """
    words = word_hashes(data)
    n = len(words)
    if not n:
        return words.view(np.int64)
    take = min(n, width)
    with np.errstate(over="ignore"):
        total = np.zeros(n - take + 1, np.uint64)
        for j in range(take):
            total += words[j:n - take + 1 + j] * _PLACES[j]
        hashes = mix(total + np.uint64(take))
    return np.unique(hashes.view(np.int64))


def texts_as_bytes(column) -> list[np.ndarray]:
    """The UTF-8 bytes of every text of an Arrow string column, without copies; null is empty."""
    import pyarrow as pa

    column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    if data is None:
        return [np.zeros(0, np.uint8)] * len(column)
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


def lists_of(arrays: list[np.ndarray]):
    """An Arrow column of lists of longs."""
    import pyarrow as pa

    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64, copy=False)))
