"""Fitted statistics as a table: (feature, kind, median, mean, scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["STATS_SCHEMA", "save_stats", "load_stats", "stats_frame", "stats_dict"]

STATS_SCHEMA = "feature string, kind string, median double, mean double, scale double"


def stats_frame(spark: SparkSession, rows: dict) -> DataFrame:
    """Rows of the statistics table; one per column, so at most a few hundred."""
    data = [
        (name, r["kind"], r.get("median"), r.get("mean"), r.get("scale"))
        for name, r in rows.items()
    ]
    return spark.createDataFrame(data, STATS_SCHEMA)


def stats_dict(stats: DataFrame) -> dict:
    """The statistics as literals for expressions: one row per feature column."""
    return {r["feature"]: r.asDict() for r in stats.collect()}


def save_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str, features=None) -> DataFrame:
    """The statistics, or those of one tower's features only."""
    stats = spark.read.schema(STATS_SCHEMA).parquet(path)
    return stats if features is None else stats.where(F.col("feature").isin(*features))
