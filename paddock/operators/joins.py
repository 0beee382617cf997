"""Joins of a large side to a side with one row per key.

A third of the large side may carry one key.  The join is on one struct of the
keys, whatever partitioning the inputs have, so both sides come in as plain
shuffles and runtime skew handling can split every partition that turns out
large, a single hot key included, by what was measured: no counting job, no list
of keys, no salt.  A lookup that is small enough is broadcast by Spark.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(large: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    """Join ``large`` to ``lookup``, which must hold one row per key; null keys match nothing."""
    on = [on] if isinstance(on, str) else list(on)
    known = lookup.where(reduce(and_, [F.col(c).isNotNull() for c in on]))
    right = known.select(F.struct(*on).alias("_key"), *[c for c in lookup.columns if c not in on])
    left = large.withColumn("_key", F.struct(*on))
    out = left.join(right, "_key", how).drop("_key")
    rest = [c for c in large.columns if c not in on]
    return out.select(*on, *rest, *[c for c in lookup.columns if c not in on])


def join_item_features(samples: DataFrame, items: DataFrame, on="clue_id") -> DataFrame:
    return lookup_join(samples, items, on)


def join_user_features(samples: DataFrame, users: DataFrame, on="user_id") -> DataFrame:
    return lookup_join(samples, users, on)


def join_sequences(samples: DataFrame, *sequences: DataFrame) -> DataFrame:
    """Attach sequence frames, each with one row per (user_id, ts).

    A user has few samples in one second, so no key is hot, and all joins share
    one shuffle of the samples.
    """
    for s in sequences:
        samples = samples.join(s, ["user_id", "ts"], "left")
    return samples


def join_latest_price(items: DataFrame, prices: DataFrame, on="clue_id") -> DataFrame:
    """Both sides hold one row per item (and day): no hot key, no salt."""
    return items.join(prices, on, "left")


def join_item_rates(items: DataFrame, *rates: DataFrame, on="clue_id") -> DataFrame:
    """Rate tables on the int key, one row per item (and day) each; they share one partitioning."""
    for r in rates:
        items = items.join(r, on, "left")
    return items


def sequence_items(events: DataFrame, items: DataFrame, on="clue_id") -> DataFrame:
    """Events with the attributes of their item; unknown items drop out."""
    return lookup_join(events, items, on, "inner")


def attach_labels(impressions: DataFrame, labels: DataFrame, on=("clue_id", "recommend_id"),
                  flags=None) -> DataFrame:
    """Left join to flags with one row per key; missing flags are 0."""
    flags = flags or [c for c in labels.columns if c not in on]
    out = lookup_join(impressions, labels, list(on))
    return out.select(*[
        F.coalesce(F.col(c), F.lit(0)).alias(c) if c in flags else F.col(c)
        for c in out.columns
    ])


def assemble_user(spine: DataFrame, *parts: DataFrame, on="user_id") -> DataFrame:
    """Star of left joins on the user (and day); every part holds one row per key.

    The parts come out of aggregations on that key, so all sides already share
    that partitioning and the chain needs no further shuffle.
    """
    for p in parts:
        spine = spine.join(p, on, "left")
    return spine
