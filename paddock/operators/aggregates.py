"""Grouped reductions.  All combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, key="clue_id", ts="ts", out="on_sale_ts", by=()) -> DataFrame:
    return df.groupBy(*by, key).agg(F.min(ts).alias(out))


def query_heads(df: DataFrame, keys=("user_id", "recommend_id", "page"), ts="ts",
                out="query_ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias(out))


def distinct_rows(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols).distinct()


def _names(key) -> list:
    return [key] if isinstance(key, str) else list(key)


def pivot_max(df: DataFrame, key, cols: dict, else_=0) -> DataFrame:
    """``cols``: output name -> (action, source column)."""
    return df.groupBy(*_names(key)).agg(*[
        F.max(F.when(F.col("action") == action, F.col(src)).otherwise(F.lit(else_))).alias(name)
        for name, (action, src) in cols.items()
    ])


def pivot_stats(df: DataFrame, key, cols: dict) -> DataFrame:
    """Statistics by action and window in one pass; absent ones stay null.

    ``cols``: output name -> (action, window days, source column); the source
    holds one row per (key, action, window).
    """
    return df.groupBy(*_names(key)).agg(*[
        F.max(F.when((F.col("action") == action) & (F.col("cnt_days") == days), F.col(src)))
        .alias(name)
        for name, (action, days, src) in cols.items()
    ])


def favourite_long(df: DataFrame, by, ratio: str, key: str = "key") -> DataFrame:
    """(by..., best_key): the key of the highest positive ratio, largest key on ties.

    Groups whose best ratio is not positive give null.
    """
    best = F.max(F.struct(F.col(ratio).alias("r"), F.col(key).alias("k")))
    out = df.groupBy(*by).agg(best.alias("_best"))
    return out.select(*by, F.when(F.col("_best.r") > 0, F.col("_best.k")).alias("best_key"))


def favourites_long(df: DataFrame, by, ratios, key: str = "key") -> DataFrame:
    """(by..., ratio, best_key): the rows of :func:`favourite_long` for each of the ratio columns, in one pass."""
    best = df.groupBy(*by).agg(*[F.max(F.struct(F.col(r).alias("r"), F.col(key).alias("k"))).alias(f"_{r}") for r in ratios])
    each = F.explode(F.array(*[
        F.struct(F.lit(r).alias("ratio"), F.when(F.col(f"_{r}.r") > 0, F.col(f"_{r}.k")).alias("best_key")) for r in ratios]))
    return best.select(*by, each.alias("_best")).select(*by, "_best.ratio", "_best.best_key")


def favourite(df: DataFrame, ratio: str, cols: dict, by=("user_id", "action", "cluster"),
              key: str = "key", none="-1", shift=None) -> DataFrame:
    """One row per user: the favourite category for each (action, cluster).

    ``cols``: output name -> the values of ``by[1:]``.  ``shift`` names outputs
    whose numeric key is moved up by one, with 1 where there is none.
    """
    best = favourite_long(df, by, ratio, key)
    shift = set(shift or ())
    aggs = []
    for name, values in cols.items():
        here = F.lit(True)
        for c, v in zip(by[1:], values):
            here = here & (F.col(c) == v)
        found = F.max(F.when(here, F.col("best_key")))
        if name in shift:
            aggs.append(F.coalesce(found.try_cast("int") + 1, F.lit(1)).alias(name))
        else:
            aggs.append(F.coalesce(found, F.lit(none)).alias(name))
    return best.groupBy(by[0]).agg(*aggs)


def fit_scaler(df: DataFrame, cols) -> dict:
    """{column: (mean, population deviation or 1)}; one row leaves the cluster."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}


def scaler_long(values: DataFrame) -> DataFrame:
    """(feature, mean, scale) from (feature, value) rows; zero deviation gives 1."""
    out = values.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("scale"))
    return out.withColumn("scale", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")))


def label_balance(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))
