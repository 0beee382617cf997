"""SentencePiece encoding with the n best segmentations, and decoding, of whole columns.

The vocabulary (bounded by its file) goes to the tasks once; texts stay in their
rows and nothing is shuffled.  A worker keeps a bounded cache of segments, so its
memory depends on one batch of rows and not on the corpus.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import let, packed
from paddock.llm.piece_lattice import UNIT, Lattice, Pieces

N_BEST = 4
#: Texts whose segments are searched together.
TOGETHER = 200
_LATTICES: dict = {}


def _lattice(shared) -> Lattice:
    """One lattice per worker and vocabulary, with its cache."""
    pieces = shared.value
    key = hash((pieces.texts, pieces.scores))
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattice(pieces)
    return _LATTICES[key]


def _ids(column: list[bytes]):
    import numpy as np
    import pyarrow as pa

    ends = np.zeros(len(column) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in column], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(column), "<i4")))


def segmentation(ids: Column, edits: Column) -> Column:
    """The ids of one of the others: ``ids`` with its ``edits`` made."""
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("at"))
    done = F.aggregate(edits, start, lambda a, e: F.struct(
        F.concat(a["ids"], F.slice(ids, a["at"] + 1, e["at"] - a["at"]), e["ids"]).alias("ids"),
        (e["at"] + e["cut"]).alias("at")))
    return let(done, lambda d: F.concat(d["ids"], F.slice(ids, d["at"] + 1, F.size(ids))))


def encode(df: DataFrame, pieces: Pieces, text: str = "text", n: int = N_BEST) -> DataFrame:
    """Every row of ``df`` as ``_row``, with ``ids`` (the best segmentation),
    ``n_pieces``, ``scores`` (natural log, of the ``n`` best in order), ``digests``
    (CRC-32 of each one's ids as little-endian int32), ``others`` (the second best
    and on, in order, each as its changes of the best: from the id ``at`` on, counted
    from 0, ``cut`` ids give way to ``ids``; :func:`segmentation` makes them) and
    ``round_trip`` (the ids decode to the text).

    A null or empty text has one segmentation, of no pieces and score 0; ties go
    in a fixed order; equal texts get equal results; an empty table an empty one.
    """
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        lattice = _lattice(shared)
        kind = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("cut", pa.int32()), ("ids", pa.list_(pa.int32()))])))
        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                b = whole.slice(low, TOGETHER)
                texts = [t or "" for t in b.column(1).to_pylist()]
                found = [lattice.ranked(t, n, at) for t, at in zip(texts, lattice.prepare(texts))]
                ids = [[x for _, x, _ in f] for f in found]
                scores = [[s / UNIT for s, _, _ in f] for f in found]
                digests = [[f"{zlib.crc32(x):08x}" for x in xs] for xs in ids]
                others = [[[{"at": at, "cut": cut, "ids": np.frombuffer(x, "<i4")} for at, cut, x in edits]
                           for _, _, edits in f[1:]] for f in found]
                same = [lattice.decode(np.frombuffer(xs[0], "<i4").tolist()) == t for xs, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), _ids([xs[0] for xs in ids]), pa.array([len(xs[0]) // 4 for xs in ids], pa.int64()),
                     pa.array(scores, pa.list_(pa.float64())), pa.array(digests, pa.list_(pa.string())),
                     pa.array(others, kind),
                     pa.array(same, pa.bool_())],
                    ["_row", "ids", "n_pieces", "scores", "digests", "others", "round_trip"])

    rows = packed(df, text=text)
    schema = T.StructType([rows.schema["_row"]] + T._parse_datatype_string(
        "ids array<int>, n_pieces long, scores array<double>, digests array<string>, "
        "others array<array<struct<at:int,cut:int,ids:array<int>>>>, round_trip boolean").fields)
    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, pieces: Pieces, ids: str = "ids") -> DataFrame:
    """Every row of ``df`` as ``_row``, with ``decoded``; null ids give null, ids
    outside the vocabulary a row's null."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        import pyarrow as pa

        lattice = _lattice(shared)
        size = len(lattice.bytes_of)

        def text(x):
            fine = x is not None and all(i is not None and 0 <= i < size for i in x)
            return lattice.decode(x) if fine else None

        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text(x) for x in b.column(1).to_pylist()], pa.string())],
                ["_row", "decoded"])

    rows = packed(df, ids=ids)
    schema = T.StructType([rows.schema["_row"], T.StructField("decoded", T.StringType())])
    return rows.withColumn("ids", F.col("ids").cast("array<int>")).mapInArrow(run, schema)
