"""Quality of every text by attention over its passages, learned from document labels.

The model is fitted in one task on at most ``SAMPLE`` labelled documents of at
most ``LONGEST`` characters, chosen by a hash of their id; that is the only
bounded step.  Scoring reads every whole text where it lies: no shuffle, one
batch of rows in memory.  Only the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.attention_mil import Attention, fit
from paddock.llm.common import packed
from paddock.llm.passages import passage_features
from paddock.llm.shingles import texts_as_bytes

SAMPLE, LONGEST = 4000, 20_000
THRESHOLD = 0.3


def labelled_sample(df: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id",
                    text: str = "text", label: str = "quality", size: int = SAMPLE) -> DataFrame:
    """``text`` and ``y`` of at most ``size`` labelled rows; repeated labels count as the lowest."""
    known = labels.where(learn & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("_key")).agg(F.min(label).cast("double").alias("y"))
    # ids and labels of a bounded number of rows: small enough for every task
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(size)
    texts = df.select(df[f"`{key}`"].alias("_key"), df[f"`{text}`"].alias("text")).where(
        F.length(F.coalesce("text", F.lit(""))) <= LONGEST)
    # one text of each id, however often a row or an id is repeated
    return texts.join(F.broadcast(chosen), "_key").groupBy("_key").agg(
        F.min_by(F.coalesce("text", F.lit("")), F.struct(F.xxhash64("text"), "text")).alias("text"),
        F.min("y").alias("y"))


def fitted(sample: DataFrame) -> Attention:
    """The model of a bounded sample; the same rows give the same model in any order."""

    def run(batches):
        import pyarrow as pa

        rows = []
        for b in batches:
            for k, t, y in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1)), b.column(2).to_pylist()):
                rows.append((k, t.tobytes(), y))
        rows.sort()
        bags = [passage_features(np.frombuffer(t, np.uint8)).astype(np.float16) for _, t, _ in rows]
        model = fit(bags, np.array([y for _, _, y in rows]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([[p.ravel().tolist() for p in model.parts()]], pa.list_(pa.list_(pa.float64())))], ["parts"])

    row = sample.coalesce(1).mapInArrow(run, "parts array<array<double>>").first()
    fresh = Attention.fresh()
    if row is None:
        return fresh
    return Attention(*[np.array(p).reshape(q.shape) for p, q in zip(row.parts, fresh.parts())])


def score_quality(df: DataFrame, model: Attention, text: str = "text") -> DataFrame:
    """Every row of ``df`` as ``_row``, with ``score`` (0 to 1), ``n_passages`` and
    ``attention``, the largest weight of one passage.

    A null or empty text is one empty passage; equal texts score alike; an empty
    table gives an empty one.
    """
    shared = df.sparkSession.sparkContext.broadcast(Attention(*[p.astype(np.float32) for p in model.parts()]))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            scores, sizes, most = [], [], []
            for t in texts_as_bytes(b.column(1)):
                x = passage_features(t)
                p, a, _ = shared.value.forward(x, np.zeros(1, np.int64))
                scores.append(float(p[0]))
                sizes.append(len(x))
                most.append(float(a.max()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64()),
                 pa.array(most, pa.float64())], ["_row", "score", "n_passages", "attention"])

    rows = packed(df, text=text)
    schema = T.StructType([rows.schema["_row"]] + T._parse_datatype_string(
        "score double, n_passages long, attention double").fields)
    return rows.mapInArrow(run, schema)
