"""Text encodings of arrays and the row sets handed to outside stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import from_json_array, to_json_array

__all__ = [
    "encode_arrays_json", "decode_arrays_json", "kv_payload", "upsert_payload",
    "merge_upsert",
]

# Lifetime of a stored vector, in seconds.
VECTOR_TTL = 604800


def encode_arrays_json(df: DataFrame, cols) -> DataFrame:
    cols = set(cols)
    return df.select(*[to_json_array(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def decode_arrays_json(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    cols = set(cols)
    return df.select(
        *[from_json_array(c, dtype).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def kv_payload(df: DataFrame, key_format: str, key="user_id", vector="embedding",
               ttl: int = VECTOR_TTL) -> DataFrame:
    """(key, JSON vector, lifetime) rows for a key-value store."""
    return df.select(
        F.format_string(key_format, F.col(key).cast("string")).alias("key"),
        to_json_array(vector).alias("value"),
        F.lit(ttl).alias("ttl"),
    )


def upsert_payload(df: DataFrame, model_version: str, key="clue_id", vector="embedding",
                   order=None) -> DataFrame:
    """(key, JSON vector, model version), the latest row per key."""
    if order is not None:
        w = Window.partitionBy(key).orderBy(F.col(order).desc())
        df = df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return df.select(
        F.col(key), to_json_array(vector).alias("embedding"),
        F.lit(model_version).alias("model_version"),
    )


def merge_upsert(stored: DataFrame, changes: DataFrame, key="clue_id") -> DataFrame:
    """Stored rows with the changed keys replaced."""
    kept = stored.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.select(*stored.columns))
