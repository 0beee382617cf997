"""Words, capitals, code points and symbols of many UTF-8 texts in one finite-state pass, in numpy.

The transducer reads bytes.  Its state says whether the byte before was part of a
word, and a table gives what each (text begins, state, kind of byte) puts out.  As
the next state depends on the byte alone, the states of a whole block are known at
once and the table is applied to all its bytes in one step; blocks of any size
follow each other with the state handed on.

Word spans go into a hash table by open addressing.  A hash only finds the slot:
whether a word is the one in it is told by text, length and every byte.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from paddock.llm.shingles import mix

BLANK, CAPITAL, SYMBOL, INNER, OTHER = range(5)
STARTS, ENDS, CAPITALS, POINTS, SYMBOLS = 1, 2, 4, 8, 16
#: Bytes a block of the pass holds; what it needs beside the text.
BLOCK = 1 << 20
#: Texts are measured together up to so many bytes; a longer one alone.
TOGETHER = 1 << 22
#: Words beyond so many bytes are hashed and compared as a whole.
LONG = 256

KINDS = np.full(256, OTHER, np.uint8)
KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = BLANK
KINDS[65:91] = CAPITAL
KINDS[[ord(c) for c in "#$%&*|"]] = SYMBOL
KINDS[0x80:0xC0] = INNER


def _table() -> np.ndarray:
    """What is put out, by (text begins here, inside a word before, kind of byte)."""
    out = np.zeros((2, 2, 5), np.uint8)
    for begins in range(2):
        for inside in range(2):
            for kind in range(5):
                put = 0 if kind == INNER else POINTS
                if kind != BLANK and (begins or not inside):
                    put |= STARTS
                if inside and (begins or kind == BLANK):
                    put |= ENDS
                put |= {CAPITAL: CAPITALS, SYMBOL: SYMBOLS}.get(kind, 0)
                out[begins, inside, kind] = put
    return out.reshape(-1)


TABLE = _table()


def transduce(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, counts) of the texts ``data[offsets[i]:offsets[i + 1]]``.

    ``starts`` and ``ends`` are the word spans in order; ``counts`` has a row of
    capitals, code points and symbols per text.
    """
    n = len(offsets) - 1
    counts = np.zeros((n, 3), np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    firsts = offsets[:-1][filled]
    starts, ends, inside = [], [], 0
    for low in range(int(offsets[0]), int(offsets[-1]), BLOCK):
        block = data[low:min(low + BLOCK, int(offsets[-1]))]
        kinds = KINDS[block]
        state = np.empty(len(block), np.uint8)
        state[0] = inside
        np.not_equal(kinds[:-1], BLANK, out=state[1:].view(bool))
        inside = int(kinds[-1] != BLANK)
        index = state * np.uint8(5) + kinds
        a, b = np.searchsorted(firsts, [low, low + len(block)])
        here = firsts[a:b] - low
        index[here] += np.uint8(10)
        put = TABLE[index]
        starts.append(np.flatnonzero(put & STARTS) + low)
        ends.append(np.flatnonzero(put & ENDS) + low)
        # the texts of this block: those that begin in it, and the one that goes on
        whose = filled[a:b]
        if a and (not len(here) or here[0]):
            here, whose = np.concatenate([[0], here]), np.concatenate([filled[a - 1:a], whose])
        for column, bit in enumerate((CAPITALS, POINTS, SYMBOLS)):
            flags = (put & bit) != 0
            if len(here):
                counts[whose, column] += np.add.reduceat(flags, here, dtype=np.int64)
    if inside:
        ends.append(offsets[-1:].astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate(starts or [none]), np.concatenate(ends or [none]), counts


class Spans:
    """Word spans over one buffer, with a hash of each one's text and bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray):
        self.data, self.starts, self.text = data, starts, text
        self.lengths = ends - starts
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        with np.errstate(over="ignore"):
            self.hashes = mix(text.astype(np.uint64) + self.lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            todo = np.flatnonzero(self.lengths <= LONG)
            at = 0
            while len(todo):
                self.hashes[todo] = mix((self.hashes[todo] ^ self._piece(todo, at)) + np.uint64(at + 1))
                at += 8
                todo = todo[self.lengths[todo] > at]
            for i in np.flatnonzero(self.lengths > LONG):
                digest = blake2b(self._bytes(i), digest_size=8).digest()
                self.hashes[i] ^= np.uint64(int.from_bytes(digest, "little"))

    def _piece(self, which: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at + 8`` of the spans, what lies beyond them as zeros."""
        left = np.minimum(self.lengths[which] - at, 8)
        drop = ((8 - left) * 8).astype(np.uint64)
        return (self.eight[self.starts[which] + at] << drop) >> drop

    def _bytes(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i] + self.lengths[i]].tobytes()

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the spans ``a`` are words of the same text and bytes as those of ``b``."""
        out = (self.text[a] == self.text[b]) & (self.lengths[a] == self.lengths[b])
        todo = np.flatnonzero(out & (self.lengths[a] <= LONG))
        at = 0
        while len(todo):
            equal = self._piece(a[todo], at) == self._piece(b[todo], at)
            out[todo[~equal]] = False
            at += 8
            todo = todo[equal]
            todo = todo[self.lengths[a[todo]] > at]
        for i in np.flatnonzero(out & (self.lengths[a] > LONG)):
            out[i] = self._bytes(a[i]) == self._bytes(b[i])
        return out


def first_of_each(spans: Spans, hashes: np.ndarray | None = None) -> np.ndarray:
    """One span of each different word of each text, by a verified hash table.

    In a round all open spans look at their slot; one of those that meet in an
    empty one takes it; who finds an equal word there is done, all others go on.
    """
    hashes = spans.hashes if hashes is None else hashes
    n = len(hashes)
    size = 1 << max(4, int(2 * n).bit_length())
    table = np.full(size, -1, np.int64)
    slot = (hashes & np.uint64(size - 1)).astype(np.int64)
    open_, new = np.arange(n), np.zeros(n, bool)
    while len(open_):
        at = slot[open_]
        empty = table[at] < 0
        table[at[empty]] = open_[empty]
        owner = table[at]
        mine = owner == open_
        new[open_[mine]] = True
        open_, owner = open_[~mine], owner[~mine]
        open_ = open_[~spans.same(open_, owner)]
        slot[open_] = (slot[open_] + 1) & (size - 1)
    return new


def measured(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: words, distinct words, capitals, code points, symbols."""
    n = len(offsets) - 1
    out = np.zeros((n, 5), np.int64)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + TOGETHER, "right")) - 1)
        part = data[offsets[low]:offsets[high]]
        own = (offsets[low:high + 1] - offsets[low]).astype(np.int64)
        starts, ends, counts = transduce(part, own)
        text = np.searchsorted(own, starts, "right") - 1
        new = first_of_each(Spans(part, starts, ends, text))
        out[low:high, 0] = np.bincount(text, minlength=high - low)
        out[low:high, 1] = np.bincount(text[new], minlength=high - low)
        out[low:high, 2:] = counts
        low = high
    return out
