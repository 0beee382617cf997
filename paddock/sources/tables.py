"""Scans of day-partitioned tables.

Each takes a DataFrame with a ``dt`` column ('yyyy-MM-dd' text, the partition
column of the stored table) and returns a filter on literals, so Spark prunes
partitions and pushes the rest to the file scan.
"""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

__all__ = [
    "read_table", "shift_day", "scan_day", "scan_window", "scan_snapshot",
    "scan_dictionary", "scan_days", "count_by_day", "scan_listed_days", "read_tsv",
]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shift_day(day: str, days: int) -> str:
    return (datetime.date.fromisoformat(day) + datetime.timedelta(days=days)).isoformat()


def scan_day(table: DataFrame, dt: str, **parts: str) -> DataFrame:
    """One day, and one value of each further partition column."""
    keep = F.col("dt") == dt
    for name, value in parts.items():
        keep = keep & (F.col(name) == value)
    return table.where(keep)


def scan_window(table: DataFrame, dt: str, lo: int, hi: int) -> DataFrame:
    """Days ``dt+lo`` to ``dt+hi``, both included."""
    return table.where(F.col("dt").between(shift_day(dt, lo), shift_day(dt, hi)))


def scan_snapshot(table: DataFrame, dt: str, lag: int = 1) -> DataFrame:
    """The snapshot of ``lag`` days earlier: what was known before the day began."""
    return table.where(F.col("dt") == shift_day(dt, -lag)).drop("dt")


def scan_dictionary(table: DataFrame, version: str) -> DataFrame:
    """One pinned version of the encoding dictionary."""
    return table.where(F.col("dt") == version).select("fea_name", "fea_val", "encode_id")


def scan_days(table: DataFrame, start: str, end: str, skip: tuple = ()) -> DataFrame:
    """All present days from ``start`` to ``end`` but for the listed ones."""
    out = table.where(F.col("dt").between(start, end))
    return out.where(~F.col("dt").isin(*skip)) if skip else out


def count_by_day(table: DataFrame, name: str = "n") -> DataFrame:
    """Rows per day."""
    return table.groupBy("dt").agg(F.count("*").alias(name))


def scan_listed_days(table: DataFrame, days: DataFrame) -> DataFrame:
    """The days of a frame.  Its rows prune the partitions of ``table`` while the query runs."""
    listed = days.select("dt").distinct()
    # a row per day: as many as the table has partitions
    return table.join(F.broadcast(listed), "dt", "left_semi")


def read_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated files with a header; a path that is not there gives no rows."""
    try:
        # quotes off: the vectors are written as bare bracketed text
        return spark.read.csv(path, sep="\t", header=True, schema=schema, quote="")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
