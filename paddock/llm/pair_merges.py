"""Byte-pair merging of many words at once: rounds over one flat array, in numpy.

All symbols of all words stand in one array.  A round gives every neighbouring pair
its rank (binary search of its key among the sorted keys of all merges), picks each
word's lowest and merges all places that have it; then only pairs beside a merged
place get a new rank.  Words without a pair left leave the array.

A word may be of any length.  Beyond ``WIDE`` symbols it does not wait for the
lowest pair of the whole word: a place is merged as soon as no pair within ``reach``
of it is lower.  No token is longer than that, so nothing that happens further away
can come before it, and the result is the same.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np

NEVER = np.int64(1 << 60)
#: Symbols up to which a word is merged by its one lowest pair a round.
WIDE = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


@dataclass
class Merges:
    """A byte-level vocabulary: ids of bytes, merges by rank, bytes of ids, special texts."""

    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray
    size: int
    tokens: list = field(repr=False)
    specials: dict

    @classmethod
    def load(cls, path: str) -> Merges:
        """From a tokenizer file; anything a byte-level vocabulary of this kind has not is refused."""
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        plain = (file.get("normalizer") is None and before.get("type") == "ByteLevel"
                 and not before.get("add_prefix_space") and before.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "byte_fallback", "ignore_merges")))
        added = file.get("added_tokens") or []
        if not plain or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls.of(vocab, pairs, {t["content"]: t["id"] for t in added})

    @classmethod
    def of(cls, vocab: dict, pairs: list, specials: dict) -> Merges:
        letters = byte_letters()
        size = max([*vocab.values(), *specials.values()]) + 1
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        products = np.array([vocab[a + b] for a, b in pairs], np.int64)
        made = np.full(size, -1, np.int64)
        made[products] = np.arange(len(pairs))
        # rounds merge equal pairs together: right only if a product is made once, after its parts
        if len(set(products.tolist())) < len(pairs) or (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError("merges are not in the order they were learned")
        order = np.argsort(left * size + right)
        back = {c: b for b, c in enumerate(letters)}
        tokens = [b""] * size
        for text, i in vocab.items():
            known = all(c in back for c in text)
            tokens[i] = bytes(back[c] for c in text) if known else text.encode()
        for text, i in specials.items():
            tokens[i] = text.encode()
        return cls(np.array([vocab[c] for c in letters], np.int64), (left * size + right)[order],
                   order.astype(np.int64), products, size, tokens, dict(specials))

    @property
    def reach(self) -> int:
        return max(map(len, self.tokens))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NEVER`` where there is no such merge."""
        if not len(self.keys):
            return np.full(len(a), NEVER)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)


def _alternate(chosen: np.ndarray) -> np.ndarray:
    """Of places that follow one another (a pair of equal symbols) the first, third, ..."""
    places = np.flatnonzero(chosen)
    fresh = np.ones(len(places), bool)
    fresh[1:] = np.diff(places) > 1
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
    return places[(np.arange(len(places)) - first) % 2 == 0]


def _merged(merges: Merges, symbols, ranks, last, places):
    """``symbols``, ``ranks`` and ``last`` (ends of words) with the pairs at ``places`` merged."""
    symbols[places] = merges.products[ranks[places]]
    last[places] = last[places + 1]
    stay = np.ones(len(symbols), bool)
    stay[places + 1] = False
    now = places - np.arange(len(places))
    symbols, ranks, last = symbols[stay], ranks[stay], last[stay]
    beside = np.zeros(len(symbols), bool)
    beside[now] = True
    beside[np.maximum(now - 1, 0)] = True
    touched = np.flatnonzero(beside)
    ended = last[touched]
    ranks[touched[ended]] = NEVER
    touched = touched[~ended]
    ranks[touched] = merges.rank(symbols[touched], symbols[touched + 1])
    return symbols, ranks, last


def _begin(merges: Merges, words: list[bytes]):
    lengths = np.array([len(w) for w in words], np.int64)
    symbols = merges.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(lengths) - 1] = True
    ranks = np.full(len(symbols), NEVER)
    inner = np.flatnonzero(~last)
    ranks[inner] = merges.rank(symbols[inner], symbols[inner + 1])
    return symbols, ranks, last


def merge_words(merges: Merges, words: list[bytes]) -> list[bytes]:
    """The ids of each (non-empty) word as little-endian unsigned 32-bit integers."""
    out: list = [b""] * len(words)
    if not words:
        return out
    symbols, ranks, last = _begin(merges, words)
    names = np.arange(len(words))
    while len(names):
        ends = np.flatnonzero(last)
        starts = np.concatenate([[0], ends[:-1] + 1])
        lowest = np.minimum.reduceat(ranks, starts)
        done = lowest == NEVER
        if done.any():
            flat = symbols.astype("<u4")
            for i in np.flatnonzero(done).tolist():
                out[names[i]] = flat[starts[i]:ends[i] + 1].tobytes()
            stay = np.repeat(~done, ends - starts + 1)
            symbols, ranks, last = symbols[stay], ranks[stay], last[stay]
            names, lowest = names[~done], lowest[~done]
            if not len(names):
                break
        word = np.concatenate([[0], np.cumsum(last[:-1])])
        chosen = (ranks == lowest[word]) & (ranks < NEVER)
        symbols, ranks, last = _merged(merges, symbols, ranks, last, _alternate(chosen))
    return out


def _lowest_near(ranks: np.ndarray, reach: int) -> np.ndarray:
    """The lowest rank within ``reach`` places to either side, by doubling windows."""
    size = 2 * reach + 1
    padded = np.full(len(ranks) + 2 * reach, NEVER)
    padded[reach:reach + len(ranks)] = ranks
    width = 1
    while 2 * width <= size:
        padded = np.minimum(padded[:-width], padded[width:])
        width *= 2
    rest = size - width
    return np.minimum(padded[:len(ranks)], padded[rest:rest + len(ranks)])


def merge_long(merges: Merges, word: bytes) -> bytes:
    """The same for one word of any length, in time and memory by its length."""
    symbols, ranks, last = _begin(merges, [word])
    reach = merges.reach
    while True:
        safe = (ranks < NEVER) & (ranks == _lowest_near(ranks, reach))
        if not safe.any():
            return symbols.astype("<u4").tobytes()
        # places that overlap are merged from the left: together or not yet
        fresh = np.ones(len(ranks), bool)
        fresh[1:] = ranks[1:] != ranks[:-1]
        run = np.cumsum(fresh) - 1
        whole = np.logical_and.reduceat(safe, np.flatnonzero(fresh))
        symbols, ranks, last = _merged(merges, symbols, ranks, last, _alternate(whole[run]))


def merge_all(merges: Merges, words: list[bytes]) -> list[bytes]:
    short = merge_words(merges, [w for w in words if len(w) <= WIDE])
    it = iter(short)
    return [next(it) if len(w) <= WIDE else merge_long(merges, w) for w in words]
