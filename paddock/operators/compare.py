"""Comparison of two runs: vectors and features, new against old."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import cosine

# Vectors closer than this are the same vector.
TOLERANCE = 1e-6


def _paired(new: DataFrame, old: DataFrame, key: str, vector: str) -> DataFrame:
    """One row per new key; both sides hold unique keys."""
    before = old.select(key, F.col(vector).alias("_old"), F.lit(True).alias("_known"))
    return new.join(before, key, "left")


def changed_embeddings(new: DataFrame, old: DataFrame, key="user_id", vector="embedding",
                       tol: float = TOLERANCE) -> DataFrame:
    """New keys, and keys whose vector turned away by more than ``tol``.

    An undefined cosine (a zero vector) counts as changed.
    """
    cos = cosine(vector, "_old")
    pairs = _paired(new, old, key, vector)
    same = F.coalesce(cos >= 1 - tol, F.lit(False))
    reason = F.when(F.col("_known").isNull(), "new").when(~same, "changed")
    return pairs.withColumn("reason", reason).where("reason is not null").drop("_old", "_known")


def refresh_all(new: DataFrame, old: DataFrame, key="clue_id", vector="embedding") -> DataFrame:
    """Every key is written again, marked new or existing."""
    pairs = _paired(new, old, key, vector)
    return pairs.withColumn(
        "reason", F.when(F.col("_known").isNull(), "new").otherwise("existing")
    ).drop("_old", "_known")


def feature_diff(a: DataFrame, b: DataFrame, keys, cols=None) -> DataFrame:
    """(feature, compared, mismatched, rate): per column, over keys of either side.

    A key on one side only differs in every column that is not null there.
    """
    cols = cols or [c for c in a.columns if c not in keys]
    right = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols])
    both = a.join(right, list(keys), "full")
    sums = both.agg(F.count("*").alias("_n"), *[
        F.sum(F.when(F.col(c).eqNullSafe(F.col(f"_b_{c}")), 0).otherwise(1)).alias(c)
        for c in cols
    ])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col("_n").alias("compared"),
                 F.col(c).alias("mismatched"))
        for c in cols
    ]))
    return sums.select(rows.alias("r")).select("r.*").withColumn(
        "rate", F.round(F.col("mismatched") / F.col("compared"), 6))


def vector_diff(a: DataFrame, b: DataFrame, key="vec_id", vector="embedding",
                tol: float = TOLERANCE) -> DataFrame:
    """One row: keys on both sides, keys on one side, vectors that differ, lowest cosine."""
    left = a.select(key, F.col(vector).alias("_a"), F.lit(1).alias("_in_a"))
    right = b.select(key, F.col(vector).alias("_b"), F.lit(1).alias("_in_b"))
    both = left.join(right, key, "full").withColumn("_cos", cosine("_a", "_b"))
    paired = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    differs = paired & ~F.coalesce(F.col("_cos") >= 1 - tol, F.lit(False))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))

    return both.agg(
        total(paired).alias("compared"), total(~paired).alias("unpaired"),
        total(differs).alias("different"), F.round(F.min("_cos"), 6).alias("min_cosine"))
