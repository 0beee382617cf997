"""Tables kept by version, with a pointer to the current one.

A version is written once under a folder of its own and never changed.  The pointer
is a small file that is replaced by one rename, so a reader sees the version before
or the version after and nothing in between; a run that fails leaves the pointer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

__all__ = ["write_version", "read_version", "current_version", "list_versions"]

POINTER = "_current"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version the pointer names; None before the first."""
    jvm, at, fs = _folder(spark, f"{root}/{POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def list_versions(spark: SparkSession, root: str) -> list[str]:
    """All versions with a folder, finished or not."""
    _, at, fs = _folder(spark, root)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n.removeprefix("version=") for n in names if n.startswith("version="))


def write_version(df: DataFrame, root: str, version: str | None = None, move: bool = True) -> DataFrame:
    """Write ``df`` as a version, point to it (unless not to ``move``), and return it as read back.

    An unfinished attempt at the same version is replaced; a version that is current is not.
    """
    spark = df.sparkSession
    version = version or uuid.uuid4().hex
    if version == current_version(spark, root):
        raise ValueError(f"version {version} of {root} is in use")
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    if move:
        point_to(spark, root, version)
    return read_version(spark, root, version)


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Make a finished version the current one."""
    jvm, new, fs = _folder(spark, f"{root}/_next-{uuid.uuid4().hex}")
    stream = fs.create(new)
    stream.writeUTF(version)
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), rename)


def read_version(spark: SparkSession, root: str, version: str | None = None, schema=None) -> DataFrame:
    """A version, by default the current one; no rows of ``schema`` before the first."""
    version = version or current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/version={version}")
