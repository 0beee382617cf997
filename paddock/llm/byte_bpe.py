"""Byte-level BPE encoding and decoding of whole columns.

The vocabulary (bounded by its file) goes to the tasks once; texts stay in their
rows and nothing is shuffled.  A worker merges the words of many rows together that
it has not met before and keeps a bounded number of them; long texts are taken in
slices of words, so memory depends on a slice, the ids of one batch and the cache.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import packed
from paddock.llm.pair_merges import WIDE, Merges, merge_all

#: Words that are looked up and merged together; words a worker keeps.
TOGETHER, KEPT = 200_000, 200_000
#: Fixed by the kind of vocabulary: endings, letters, numbers, others, blanks not before a word, blanks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{l}+| ?{n}+| ?[^{s}{l_}{n_}]+|[{s}]+(?![^{s}])|[{s}]+"
ASCII = SPLIT.format(l="[A-Za-z]", n="[0-9]", l_="A-Za-z", n_="0-9", s=r"\x09-\x0D\x20")


def _newer() -> str:
    """Letters and numbers that ``regex`` knows and the Unicode tables of Python do not have yet.

    The vocabulary's own splitter does not know them either; they are other characters.
    """
    import regex

    every = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


class Splitter:
    """Text to words, in order; the words together are the text."""

    def __init__(self, specials, newer: str):
        import regex

        self.newer = frozenset(newer)
        self.ascii = re.compile(ASCII)
        names = {"l": r"\p{L}", "n": r"\p{N}", "l_": r"\p{L}", "n_": r"\p{N}", "s": r"\s"}
        self.usual = regex.compile(SPLIT.format(**names))
        known = f"(?![{newer}])" if newer else ""
        self.rare = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:{known}\p{{L}})+| ?(?:{known}\p{{N}})+"
            rf"| ?(?:[^\s\p{{L}}\p{{N}}]|[{newer or chr(0)}])+|\s+(?!\S)|\s+")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")"
                                   ) if specials else None

    def _pattern(self, text: str):
        if text.isascii():
            return self.ascii
        return self.usual if self.newer.isdisjoint(text) else self.rare

    def words(self, text: str):
        """Lists of words of bounded length; a special text is a word of its own."""
        parts = [text]
        if self.specials and self.specials.search(text):
            parts = self.specials.split(text)
        for i, part in enumerate(parts):
            if i % 2:
                yield [part]
            elif len(part) <= TOGETHER:
                yield self._pattern(part).findall(part)
            else:
                found = self._pattern(part).finditer(part)
                while piece := [m.group() for m in islice(found, TOGETHER)]:
                    yield piece


class Encoder:
    def __init__(self, merges: Merges, newer: str):
        self.merges = merges
        self.special = {t: i.to_bytes(4, "little") for t, i in merges.specials.items()}
        self.splitter = Splitter(merges.specials, newer)
        self.known, self.before = dict(self.special), {}

    def _learn(self, lists) -> list[str]:
        """Have the ids of all words in ``known``; returns those that should not stay there.

        A full cache becomes the one before; what is met again moves on from there.
        """
        if len(self.known) > KEPT:
            self.known, self.before = dict(self.special), self.known
        fresh = set().union(*lists).difference(self.known)
        again = fresh.intersection(self.before)
        self.known.update((w, self.before[w]) for w in again)
        fresh = sorted(fresh.difference(again))
        self.known.update(zip(fresh, merge_all(self.merges, [w.encode("utf-8", "surrogatepass") for w in fresh])))
        return [w for w in fresh if len(w) > WIDE]

    def encode(self, texts) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = [[] for _ in texts]
        waiting, size = [], 0

        def flush():
            once = self._learn([words for _, words in waiting])
            for row, words in waiting:
                out[row].append(b"".join(map(self.known.__getitem__, words)))
            for w in once:
                del self.known[w]
            waiting.clear()

        for row, text in enumerate(texts):
            for words in self.splitter.words(text or ""):
                waiting.append((row, words))
                size += len(words)
                if size >= TOGETHER:
                    flush()
                    size = 0
        flush()
        return [b"".join(parts) for parts in out]


_ENCODERS: dict = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and vocabulary, with its cache."""
    if shared.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.id] = Encoder(*shared.value)
    return _ENCODERS[shared.id]


class Shared:
    """A vocabulary that has gone to the executors; made once, used by any number of frames."""

    def __init__(self, spark, merges: Merges):
        self.sent = spark.sparkContext.broadcast((merges, _newer()))
        self.id = hash((len(merges.keys), merges.size, merges.keys[:99].tobytes(), merges.products[:99].tobytes()))

    @property
    def value(self):
        return self.sent.value

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}


def encode(df: DataFrame, shared: Shared, text: str = "text") -> DataFrame:
    """Every row of ``df`` but its text as ``_row``, with ``ids``, ``n_tokens`` and ``ids_sha256``
    (lower-case hex of the ids as little-endian unsigned 32-bit integers).

    A null or empty text has no ids; special texts inside a text are their ids;
    equal texts get equal results; an empty table gives an empty one.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder = _encoder(shared)
        for b in batches:
            found = encoder.encode(b.column(1).to_pylist())
            ends = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in found], out=ends[1:])
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), ids),
                 pa.array([len(x) // 4 for x in found], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string())],
                ["_row", "ids", "n_tokens", "ids_sha256"])

    rows = packed(df, _text=text).withColumn("_text", F.col("_text").cast("string"))
    rest = [c for c in df.columns if c != text]
    # a struct needs a field: a table of texts alone keeps the text
    rows = rows.withColumn("_row", F.struct(*[F.col(f"_row.`{c}`") for c in rest or [text]]))
    schema = T.StructType([rows.schema["_row"]] + T._parse_datatype_string(
        "ids array<int>, n_tokens long, ids_sha256 string").fields)
    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, shared: Shared, ids: str = "ids") -> DataFrame:
    """Every row of ``df`` but its ids as ``_row``, with ``decoded``.

    Special ids are their texts, ids outside the vocabulary nothing, and bytes that
    are not UTF-8 the replacement character; null ids give null.
    """
    def run(batches):
        import pyarrow as pa

        merges = _encoder(shared).merges
        tokens, size = merges.tokens, merges.size

        def text(found):
            if found is None:
                return None
            return b"".join([tokens[i] for i in found if i is not None and 0 <= i < size]).decode("utf-8", "replace")

        for b in batches:
            column = b.column(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text(column[i].as_py()) for i in range(len(column))], pa.string())],
                ["_row", "decoded"])

    rest = [c for c in df.columns if c != ids]
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in rest or [ids]]).alias("_row"),
                     df[f"`{ids}`"].cast("array<int>").alias("_ids"))
    schema = T.StructType([rows.schema["_row"], T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)
