"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on; a cluster keeps its own sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Estimates know neither how far a file is compressed nor how many rows an explode
    # makes: what a join sends to every task is decided by the size measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2m",
    # a split hot key is worth one more shuffle above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes: the stages with more
    # than a hundred output columns are faster as split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder):
    """Apply :data:`SETTINGS` to a session builder; drop checkpoints nobody refers to."""
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may go without it (tests): there a temporary folder
    is made once per session.  On a cluster a missing setting is an error,
    because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="paddock-"))
        current = context.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Reliable checkpoint: the rows survive the loss of executors, and columns
    such as a partition number keep the value they had when written.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
