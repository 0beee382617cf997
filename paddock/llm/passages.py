"""A text as passages (its lines), each with hashed and counted features, in numpy."""

from __future__ import annotations

import numpy as np

from paddock.llm.shingles import mix, word_hashes

GRAMS = 256
#: Kinds of bytes that are counted: capitals, small letters, digits, symbols, ends of sentences, others.
_KINDS = np.full(256, 5, np.int64)
_KINDS[65:91] = 0
_KINDS[97:123] = 1
_KINDS[128:] = 1
_KINDS[48:58] = 2
_KINDS[[ord(c) for c in "#*$%&|<>!"]] = 3
_KINDS[[ord(c) for c in ".,;:?"]] = 4
SIZE = GRAMS + 6 + 6
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = True


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Which hashes come more than once."""
    if not len(hashes):
        return np.zeros(0, bool)
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def passage_features(data: np.ndarray) -> np.ndarray:
    """One row of ``SIZE`` features per line that holds a word; an empty text has one row of zeros.

    Hashed byte trigrams and kinds of bytes are shares of the passage; the last
    features say how much of it repeats itself or the rest of the text.
    """
    if not len(data):
        return np.zeros((1, SIZE), np.float32)
    line_of = np.cumsum(data == 10)
    line_of[data == 10] -= 1
    blank = _BLANK[data] | (data == 10)
    filled = np.bincount(line_of[~blank], minlength=line_of[-1] + 1) > 0
    if not filled.any():
        return np.zeros((1, SIZE), np.float32)
    number = np.cumsum(filled) - 1
    n = int(filled.sum())
    line = number[line_of]
    length = np.bincount(line[filled[line_of]], minlength=n).astype(np.float32)
    out = np.zeros((n, SIZE), np.float32)
    wide = data.astype(np.uint64)
    if len(data) > 2:
        with np.errstate(over="ignore"):
            grams = (wide[:-2] * np.uint64(0x9E3779B1) + wide[1:-1] * np.uint64(0x85EBCA77)
                     + wide[2:] * np.uint64(0xC2B2AE3D))
            grams = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)
        inside = (line_of[2:] == line_of[:-2]) & filled[line_of[2:]] & (data[2:] != 10)
        counts = np.bincount(line[2:][inside] * GRAMS + grams[inside], minlength=n * GRAMS)
        out[:, :GRAMS] = np.sqrt(counts.reshape(n, GRAMS) / length[:, None]) * 3
    fine = filled[line_of]
    kinds = np.bincount(line[fine] * 6 + _KINDS[data[fine]], minlength=n * 6).reshape(n, 6)
    out[:, GRAMS:GRAMS + 6] = kinds / length[:, None] * 4
    words = word_hashes(data)
    starts = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)) == -1)
    at = line[starts]
    per = np.maximum(np.bincount(at, minlength=n), 1)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    windows = np.zeros(len(words), bool)
    if len(words) >= 4:
        with np.errstate(over="ignore"):
            four = mix(words[:-3] + words[1:-2] * np.uint64(3) + words[2:-1] * np.uint64(5)
                       + words[3:] * np.uint64(7))
        windows[:len(four)] = _repeated(four)
    line_hash = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(line_hash, at, mix(words + np.arange(len(words), dtype=np.uint64)
                                     - np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])[at].astype(np.uint64)))
    tail = out[:, GRAMS + 6:]
    tail[:, 0] = np.log1p(per) / 4
    tail[:, 1] = np.bincount(at, same, n) / per * 4
    tail[:, 2] = np.bincount(at, windows, n) / per * 2
    tail[:, 3] = _repeated(line_hash)
    tail[:, 4] = windows.mean() * 2 if len(words) else 0
    tail[:, 5] = same.mean() * 4 if len(words) else 0
    return out
