"""How filters interact: what each removes, in every order, and what it would remove alone.

Every text is read once, where it lies, by the byte transducer.  What leaves the
tasks is narrow: the kept columns, five counts and a digest.  Copies are told by
digest and smallest id; then only counts per (part, set of failed filters, label)
are left, and all orders are read off those.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.byte_transducer import measured
from paddock.llm.common import packed, written
from paddock.operators.joins import lookup_join

COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
FILTERS = "ABCDE"


def text_counts(df: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """``_row`` (the ``keep`` columns), ``COUNTS`` of the whole text and its SHA-256 ``digest``.

    A null text counts as an empty one: all zeros.  Rows stay as they are, repeated
    ones too; an empty table gives an empty one.  Nothing is shuffled.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    from paddock.llm.shingles import texts_as_bytes

    rows = packed(df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("_text")),
                  _text="_text").withColumn("_row", F.col("_row").dropFields("_text"))

    def run(batches):
        import numpy as np

        for b in batches:
            texts = texts_as_bytes(b.column(1))
            offsets = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(t) for t in texts], out=offsets[1:])
            data = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
            found = measured(data, offsets)
            digests = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in found.T], pa.array(digests, pa.binary())],
                ["_row", *COUNTS, "digest"])

    schema = T.StructType([rows.schema["_row"], *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("digest", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def failed_filters() -> Column:
    """The filters A to D that a row of ``text_counts`` fails, as bits."""
    tests = (F.col("n_words") < 50,
             100 * F.col("n_distinct") < 65 * F.col("n_words"),
             100 * F.col("n_capitals") > 5 * F.col("n_points"),
             F.col("n_symbols") > 0)
    bits = [F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)]
    return sum(bits[1:], bits[0])


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
           part: str = "source") -> DataFrame:
    """(id, part, fails, good, toxic) of every row; ``fails`` has bit i for filter i.

    A text equal to one with a smaller id fails E, whatever else befalls that one;
    rows of the same id are not copies of each other, and a row without an id is
    nobody's copy.  A null part is the empty text.  Several labels of one id count
    as one that has any of their marks.
    """
    counted = text_counts(docs, text, [id, part])
    rows = written(counted.select(
        F.col(f"_row.`{id}`").alias("id"), F.coalesce(F.col(f"_row.`{part}`").cast("string"), F.lit("")).alias("part"),
        failed_filters().alias("fails"), "digest"), "filter-counts")
    # one row per text that has two different ids: what is not in it has no copies
    firsts = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(
        "first < last").select("digest", "first")
    rows = lookup_join(rows, firsts, "digest").select(
        "id", "part", "fails", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("copy"))
    marks = labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t"))
    marks = marks.where("id is not null").groupBy("id").agg(
        F.coalesce(F.max("g"), F.lit(False)).alias("good"), F.coalesce(F.max("t"), F.lit(False)).alias("toxic"))
    rows = lookup_join(rows, marks.where("good or toxic"), "id")
    return rows.select(
        "id", "part", (F.col("fails") + F.when(F.col("copy"), 1 << 4).otherwise(0)).alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts per part, order of the filters and step, from (part, fails, good, toxic).

    One row each, zeros included, for every part there is; an empty table gives no rows.
    ``shapley`` follows from the sets alone: of all orders, a filter stands first among
    the failed ones of a row in an equal share.
    """
    orders = list(permutations(range(len(filters))))
    steps = [(("".join(filters[i] for i in o)), k + 1, o[k], sum(1 << i for i in o[:k]))
             for o in orders for k in range(len(o))]
    # the steps as one array: (order, step, filter, filters before it)
    columns = {"filter_order": "string", "step": "int", "own": "int", "before": "int"}
    arrays = [F.split(F.lit(",".join(str(s[i]) for s in steps)), ",").cast(f"array<{kind}>").alias(name)
              for i, (name, kind) in enumerate(columns.items())]
    counted = rows.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if("good").alias("g"), F.count_if("toxic").alias("t"))
    every = counted.select("*", F.explode(F.arrays_zip(*arrays)).alias("s")).select(
        "part", "fails", "n", "g", "t", *[F.col(f"s.{c}") for c in columns])
    hit = F.expr("fails & shiftleft(1, own) != 0")
    gone = F.expr("fails & before != 0")
    first = F.expr(f"{len(orders)} div bit_count(fails)")

    def total(column, wanted: Column) -> Column:
        return F.sum(F.when(wanted, column).otherwise(F.lit(0).cast("long")))

    return every.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), ~hit & ~gone).alias("kept"),
        total(F.col("n"), hit & ~gone).alias("removed"),
        total(F.col("n"), hit & gone).alias("redundant"),
        total(F.col("n"), hit & (F.bit_count("fails") == 1)).alias("unique_fails"),
        total(F.col("g"), hit & ~gone).alias("good_lost"),
        total(F.col("t"), hit & ~gone).alias("toxic_lost"),
        total(F.col("n") * first, hit).alias("shapley"))
