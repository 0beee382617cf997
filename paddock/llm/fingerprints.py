"""Fingerprints of texts and of edited texts from prefix polynomial hashes.

The edited text (the last half replaced by the beginning of the next document)
is never hashed anew: its spans are those of the two texts' prefixes and the few
across the seam, and the hash of its whole follows from the two prefix hashes.

Documents are dealt by ranges of descending id and sorted within each, so each
one's next stands behind it; one shuffle of the texts.  The last row of a range
meets the first row of the next range in a join of one row per range.  Ranges
hold about as many documents each, however ids are spread.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import written
from paddock.llm.prefix_hash import (BASES, PRIMES, SPAN, PrefixHashes, code_points,
                                     common_extension, fingerprint, likeness, powers, sketch)

FIELDS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_prefix long")


class Fingerprinted:
    """A text with its prefix hashes, sketch and fingerprint, each made once."""

    def __init__(self, text: str):
        self.text = text
        self.hashes = PrefixHashes(text)
        self.spans = self.hashes.all_spans(SPAN)
        self.sketch = sketch(self.spans)
        n = self.hashes.length
        self.print = fingerprint(self.hashes.span(0, n), n, self.sketch)


def edited(a: Fingerprinted, b: Fingerprinted) -> tuple[str, str]:
    """The edited text of ``a`` with its next ``b``, and its fingerprint."""
    n = a.hashes.length
    keep, take = n - n // 2, min(n // 2, b.hashes.length)
    text = a.text[:keep] + b.text[:take]
    seam = a.text[max(0, keep - SPAN + 1):keep] + b.text[:min(take, SPAN - 1)]
    parts = [sketch(a.spans[:max(0, keep - SPAN + 1)]), sketch(b.spans[:max(0, take - SPAN + 1)]),
             sketch(PrefixHashes(seam).all_spans(SPAN))]
    whole = []
    for k, p in enumerate(PRIMES):
        moved = int(b.hashes.sums[k][take]) * pow(BASES[k], keep, p) % p
        whole.append((int(a.hashes.sums[k][keep]) + moved) % p)
    return text, fingerprint(tuple(whole), keep + take, np.minimum.reduce(parts))


def compared(a: Fingerprinted, b: Fingerprinted) -> tuple:
    text, changed = edited(a, b)
    return (a.hashes.length, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), a.print, changed,
            likeness(a.print, changed), likeness(a.print, b.print),
            common_extension(a.hashes, 0, b.hashes, 0))


def _batch(keys, rows, extra=None):
    import pyarrow as pa

    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    columns = [pa.array([r[j] if r else None for r in rows], k) for j, k in enumerate(kinds)]
    names = ["id"] + [f.split()[0] for f in FIELDS.split(", ")]
    fields = [pa.array(keys, pa.int64()), *columns]
    for name, values, kind in extra or ():
        names.append(name)
        fields.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(fields, names)


def neighbour_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` and ``common_prefix`` (code points that a text
    and its next begin with) for every row of ``df``.

    The next document has the next smaller id; null ids come last, ties are in
    the order of their texts, the last one's next is the first; a single row is
    its own next.  A null text is empty.  Texts without a whole span of
    ``SPAN`` code points are alike only if equal.  An empty table gives an empty one.
    """
    import pyarrow as pa

    docs = df.select(df[f"`{key}`"].cast("long").alias("id"), F.coalesce(df[f"`{text}`"], F.lit("")).alias("text"))
    order = [F.desc_nulls_last("id"), F.xxhash64("text"), F.col("text")]
    dealt = docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order).withColumn(
        "part", F.spark_partition_id())

    def run(batches):
        last, part = None, None
        for b in batches:
            keys, rows, texts, firsts = [], [], [], []
            for i, t, p in zip(*(c.to_pylist() for c in b.columns)):
                now = Fingerprinted(t)
                if last is None:
                    part = p
                    keys, rows, texts, firsts = [i], [None], [t], [True]
                else:
                    keys.append(last[0])
                    rows.append(compared(last[1], now))
                    texts.append(None)
                    firsts.append(False)
                last = (i, now)
            yield _batch(keys, rows, [("part", [part] * len(keys), pa.int32()), ("text", texts, pa.string()),
                                      ("first", firsts, pa.bool_())])
        if last is not None:
            yield _batch([last[0]], [None], [("part", [part], pa.int32()), ("text", [last[1].text], pa.string()),
                                             ("first", [False], pa.bool_())])

    # digits of hashes are half their length under entropy coding, and as long as they are under snappy
    done = written(dealt.mapInArrow(run, f"id long, {FIELDS}, part int, text string, first boolean"), "ranges",
                   compression="zstd")
    # one number per range that holds rows: which range follows which
    parts = sorted(r.part for r in done.where("first").select("part").distinct().collect())
    follows = dict(zip(parts, parts[1:] + parts[:1]))
    after = df.sparkSession.createDataFrame(list(follows.items()), "part int, next int")
    ends = done.where("text is not null and not first").select("id", "part", "text").join(after, "part")
    starts = done.where("first").select(F.col("part").alias("next"), F.col("text").alias("other"))

    def seam(batches):
        for b in batches:
            keys, ours, theirs = (b.column(k).to_pylist() for k in range(3))
            yield _batch(keys, [compared(Fingerprinted(x), Fingerprinted(y)) for x, y in zip(ours, theirs)])

    rest = ends.join(starts, "next").select("id", "text", "other").mapInArrow(seam, f"id long, {FIELDS}")
    return done.where("text is null").select("id", *[f.split()[0] for f in FIELDS.split(", ")]).union(rest)
