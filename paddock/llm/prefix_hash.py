"""Polynomial hashes of all prefixes of a text, modulo two primes, in numpy.

With the prefix hashes of a text any of its spans has a hash in one step, so two
spans of any texts are compared in one step, and their longest common extension
takes a binary search.
"""

from __future__ import annotations

import numpy as np

#: Mersenne and another prime below 2^31: products of two residues fit in 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Spans of this many code points make up a fingerprint.
SPAN = 24
BINS = 128
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(k: int, n: int) -> np.ndarray:
    """The first ``n`` powers of base ``k``; doubled as needed."""
    while len(_POWERS[k]) < n:
        old, p = _POWERS[k], np.uint64(PRIMES[k])
        step = np.uint64(pow(BASES[k], len(old), PRIMES[k]))
        _POWERS[k] = np.concatenate([old, old * step % p])
    return _POWERS[k][:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class PrefixHashes:
    """``sums[k][i]``: the hash of the first i code points modulo prime k, highest power last."""

    def __init__(self, text: str):
        codes = code_points(text)
        self.length = len(codes)
        self.sums = []
        for k, p in enumerate(map(np.uint64, PRIMES)):
            total = np.zeros(self.length + 1, np.uint64)
            np.cumsum(codes * powers(k, self.length) % p, out=total[1:])
            self.sums.append(total % p)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The hash of a span, whatever its place: equal spans have equal ones."""
        out = []
        for k, p in enumerate(PRIMES):
            raw = (int(self.sums[k][end]) - int(self.sums[k][start])) % p
            out.append(raw * pow(BASES[k], -start, p) % p)
        return tuple(out)

    def all_spans(self, width: int, end: int | None = None) -> np.ndarray:
        """The hashes of all spans of ``width`` within the first ``end`` code points, both in one number."""
        end = self.length if end is None else end
        n = end - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        both = np.zeros(n, np.uint64)
        for k, p in enumerate(map(np.uint64, PRIMES)):
            raw = (self.sums[k][width:end + 1] + p - self.sums[k][:n]) % p
            # to the same highest power in every text: times the inverse power of the start
            both = (both << np.uint64(31)) | (raw * inverse_powers(k, n) % p)
        return both


_INVERSES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def inverse_powers(k: int, n: int) -> np.ndarray:
    while len(_INVERSES[k]) < n:
        old, p = _INVERSES[k], PRIMES[k]
        step = np.uint64(pow(pow(BASES[k], -1, p), len(old), p))
        _INVERSES[k] = np.concatenate([old, old * step % np.uint64(p)])
    return _INVERSES[k][:n]


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points from place i of a and place j of b on are equal."""
    low, high = 0, min(a.length - i, b.length - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The smallest mixed hash in each of ``BINS`` bins; the largest number where a bin is empty."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    if len(hashes):
        with np.errstate(over="ignore"):
            x = hashes * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
        # only small numbers can be a bin's smallest: of many, look at those first
        size = len(x)
        limit = np.uint64(min(2**57, (2**57 * BINS * 16) // max(size, 1)))
        small = x[(x & np.uint64(2**57 - 1)) < limit] if size > BINS * 16 else x
        np.minimum.at(out, (small >> np.uint64(57)).astype(np.int64), small & np.uint64(2**57 - 1))
        if size > BINS * 16 and (out == np.iinfo(np.uint64).max).any():
            np.minimum.at(out, (x >> np.uint64(57)).astype(np.int64), x & np.uint64(2**57 - 1))
    return out


def fingerprint(whole: tuple[int, int], length: int, sketched: np.ndarray) -> str:
    """Length and hash of the whole text, then 16 bits of each bin ("----" if empty), as text."""
    empty = np.iinfo(np.uint64).max
    bins = "".join("----" if x == empty else f"{int(x) & 0xFFFF:04x}" for x in sketched.tolist())
    return f"{length:x}:{whole[0]:08x}{whole[1]:08x}:{bins}"


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are: 1 for equal ones, else the share of bins that agree.

    Of bins that hold a span in either; without any, 0.
    """
    if a == b:
        return 1.0
    x, y = a.rsplit(":", 1)[1], b.rsplit(":", 1)[1]
    used = same = 0
    for k in range(0, 4 * BINS, 4):
        u, v = x[k:k + 4], y[k:k + 4]
        if u != "----" or v != "----":
            used += 1
            same += u == v
    return same / used if used else 0.0
