"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["write_partition", "write_csv", "write_by_day"]


def write_partition(df: DataFrame, path: str, **parts: str) -> None:
    """Replace one static partition and leave the others alone."""
    for name, value in parts.items():
        df = df.withColumn(name, F.lit(value))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def write_csv(df: DataFrame, path: str, sep: str = ",", one_file: bool = False) -> None:
    """Headered text files.

    ``one_file`` sends all rows through one task, so it is off by default and
    meant for small exports only.
    """
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("quote", "" if sep == "\t" else '"').csv(
        path, sep=sep, header=True)


def write_by_day(df: DataFrame, path: str) -> None:
    """One folder per ``dt``; a rerun replaces the days it holds and no others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("dt").parquet(path))
