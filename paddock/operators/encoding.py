"""Category values to the ids of a pinned dictionary; 1 is unknown.

One way for a dictionary of any size: the values become long rows, one join
brings their ids (broadcast where Spark finds the dictionary small), one group
per row brings them back.  Rows without a declared key are told apart by a digest
of the values that are coded: equal ones are coded once, nothing is numbered or
written, and a task that runs again finds the same keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.joins import lookup_join

UNKNOWN = 1
#: Bytes of text of a dictionary that goes to every task, at most.
SENT_BYTES = 2 << 20


def entries(dictionary: DataFrame, features=None) -> DataFrame:
    """(fea_name, fea_val, encode_id), one row per value: a repeated value has its smallest id."""
    rows = dictionary.where("fea_name is not null and fea_val is not null")
    if features is not None:
        rows = rows.where(F.col("fea_name").isin(*sorted(set(features))))
    return rows.groupBy("fea_name", "fea_val").agg(F.min("encode_id").alias("encode_id"))


def _keyed(df: DataFrame, key, specs):
    """(rows, rows to code, the columns that tell them apart).

    A declared ``key`` must be unique.  Without one the key is a digest of the values
    to code, and each combination of values is coded once.
    """
    if key is not None:
        return df, df, [key] if isinstance(key, str) else list(key)
    # JSON leaves out nulls and names the rest: no two combinations share a text
    digest = F.unhex(F.sha2(F.to_json(F.struct(*specs)), 256))
    held = df.withColumn("_digest", digest)
    return held, held.select("_digest", *specs).dropDuplicates(["_digest"]), ["_digest"]


def _beside(df: DataFrame, wide: DataFrame, keys, columns) -> DataFrame:
    """``df`` with the columns of ``wide``; null keys are equal to null keys."""
    if keys == ["_digest"]:
        # one combination may be that of very many rows
        return lookup_join(df, wide, "_digest").select(*columns)
    wide = wide.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(wide, same, "left").select(*columns)


def encode_categories(df: DataFrame, specs: dict, dictionary: DataFrame,
                      default: int = UNKNOWN, key=None) -> DataFrame:
    """Replace columns by ids.  ``specs``: column -> dictionary feature name.

    ``key`` names columns that are unique per row, if there are any; they spare
    a digest of the values.  Null and unknown values give ``default``.
    """
    held, rows, keys = _keyed(df, key, specs)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("col"), F.lit(f).alias("fea_name"),
                 F.col(c).cast("string").alias("fea_val"))
        for c, f in specs.items()
    ])
    long = rows.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")
    coded = long.join(entries(dictionary, specs.values()), ["fea_name", "fea_val"], "left")
    wide = coded.groupBy(*keys).agg(*[
        F.max(F.when(F.col("col") == c, F.col("encode_id"))).alias(f"_c_{c}") for c in specs
    ])
    return _beside(held, wide, keys, [
        F.coalesce(F.col(f"_c_{c}"), F.lit(default)).alias(c) if c in specs else F.col(c)
        for c in df.columns
    ])


def encode_sequences(df: DataFrame, specs: dict, dictionary: DataFrame,
                     default: int = UNKNOWN, key=None) -> DataFrame:
    """The same for every element of array columns; null arrays stay null."""
    held, rows, keys = _keyed(df, key, specs)

    def elements(c, feature):
        known = F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>"))
        return F.transform(known, lambda x, i: F.struct(
            F.lit(c).alias("col"), F.lit(feature).alias("fea_name"), i.alias("pos"),
            x.alias("fea_val")))

    pairs = F.flatten(F.array(*[elements(c, f) for c, f in specs.items()]))
    long = rows.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")
    coded = long.join(entries(dictionary, specs.values()), ["fea_name", "fea_val"], "left")
    entry = F.struct("pos", F.coalesce(F.col("encode_id"), F.lit(default)).alias("id"))
    wide = coded.groupBy(*keys).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("col") == c, entry))).alias(f"_n_{c}")
        for c in specs
    ])
    return _beside(held, wide, keys, [
        F.when(F.col(c).isNotNull(),
               F.coalesce(F.col(f"_n_{c}.id"), F.array().cast("array<int>"))).alias(c)
        if c in specs else F.col(c)
        for c in df.columns
    ])


def encode_long(long: DataFrame, feature: Column, value: Column, dictionary: DataFrame,
                out: str = "encode_id", default: int = UNKNOWN) -> DataFrame:
    """Rows that already hold one value each: one join to the dictionary.

    The dictionary is measured before: a small one goes to the rows, which stay where they are.
    """
    on = ["fea_name", "fea_val"]
    keyed = long.withColumn("fea_name", feature).withColumn("fea_val", value.cast("string"))
    held = entries(dictionary)
    size = held.agg(F.sum(F.octet_length("fea_name") + F.octet_length("fea_val") + 64)).first()[0] or 0
    coded = keyed.join(F.broadcast(held) if size <= SENT_BYTES else held, on, "left")
    return coded.withColumn(out, F.coalesce(F.col("encode_id"), F.lit(default))).drop(
        *on, *({"encode_id"} - {out}))
