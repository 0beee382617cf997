"""Ranking per key.  ``row_number`` below a constant is limited before the
shuffle, so a hot key sends a few rows per task instead of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import hash32


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _ranked(df, keys, order, k):
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def latest_per_key(df: DataFrame, key, ts="ts", ties=()) -> DataFrame:
    """The row with the largest ``ts`` (then ties) per key."""
    order = [F.col(c).desc() for c in [ts, *ties]]
    return _ranked(df, key, order, 1).drop("_rn")


def first_per_key(df: DataFrame, keys, ts="ts", ties=()) -> DataFrame:
    order = [F.col(c).asc() for c in [ts, *ties]]
    return _ranked(df, keys, order, 1).drop("_rn")


def random_one_per_group(df: DataFrame, group, seed, keys) -> DataFrame:
    """One reproducible random row per group; ``keys`` tell its rows apart."""
    order = [hash32(seed, *keys).asc(), *[F.col(c).asc() for c in keys]]
    return _ranked(df, group, order, 1).drop("_rn")


def last_k_history(events: DataFrame, k: int = 10, by=("user_id",), ts="ts",
                   ties=("clue_id",)) -> DataFrame:
    """The latest ``k`` events per user; the caller bounds the days."""
    order = [F.col(c).desc() for c in [ts, *ties]]
    return _ranked(events, by, order, k).drop("_rn")
