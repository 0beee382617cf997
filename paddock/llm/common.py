"""What several operators share: word patterns, the row as one column, tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import shared_dir

#: White space as the word pattern ``[^\x20\x09-\x0D]+`` sees it.
BLANK = "[\\x20\\x09-\\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
#: Lets Spark drop a query's shuffle files as soon as its table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def packed(df: DataFrame, **named: str | Column) -> DataFrame:
    """``_row`` (all columns of ``df`` as one struct) and the ``named`` columns.

    Whatever extra columns a table has, none can clash with those that an
    operator adds; :func:`unpacked` gives them back.
    """
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row")
    return df.select(row, *[(df[f"`{c}`"] if isinstance(c, str) else c).alias(n)
                            for n, c in named.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once per row however often it is used."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, none for null."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BLANK)).otherwise(
        F.array().cast("array<string>"))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, removed when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(folder)
    return path


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors lose nothing.

    ``options`` are those of the Parquet writer.
    """
    path = scratch(df.sparkSession, label)
    conf = df.sparkSession.conf
    kept = conf.get(CLEANUP, None)
    if kept is not None:
        conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if kept is not None:
            conf.set(CLEANUP, kept)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(*frames: DataFrame | None) -> None:
    """Remove tables of :func:`written` that a later one has replaced: no plan that is still to run reads them."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path:
            spark = df.sparkSession
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
