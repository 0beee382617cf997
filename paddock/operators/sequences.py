"""Point-in-time history: the last k events a user had before a moment.

A plain join of moments to events on the user emits all pairs of a user, and a
window over a user puts all of the user in one task.  Here time is cut into
buckets.  Within (user, bucket) a running count numbers the events and a range
frame on that count picks the last k; what lies before the bucket comes from a
second, coarser pass over at most k events per bucket.  No group is larger than
the number of seconds of a bucket (times k) or of buckets of the lookback
(times k), however many rows one user has, and no pairs are made.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import array_mean, lower_median, pad_array
from paddock.operators.joins import sequence_items

BUCKET_SECONDS = 3600


def _tail(rows: DataFrame, part: list[str], at: str, k: int) -> DataFrame:
    """For each row with ``_kind`` 0, the last k ``_e`` of earlier rows.

    Rows of kind 1 carry an event; at equal ``at`` kind 0 comes first, so an
    event is only seen strictly later.
    """
    in_order = Window.partitionBy(*part).orderBy(at, "_kind", "_e")
    numbered = rows.withColumn(
        "_c", F.sum("_kind").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    last_k = Window.partitionBy(*part).orderBy("_c").rangeBetween(-(k - 1), 0)
    seen = numbered.withColumn("_tail", F.collect_list("_e").over(last_k))
    return seen.where("_kind = 0").drop("_c", "_e", "_kind")


def last_k_before(spine: DataFrame, events: DataFrame, by=("user_id",), k: int = 10,
                  lag: int = 60, payload=("clue_id",), bucket: int = BUCKET_SECONDS,
                  floor: str | None = None, seen: str | None = None) -> DataFrame:
    """(by, ts, hist): the last ``k`` events with ``event.ts + lag < ts``.

    ``hist`` is an array of (ts, payload...) structs, latest first, ties by
    payload descending.  ``spine`` may hold a moment more than once; the result
    has one row per distinct (by, ts) with a known key.  ``floor`` names a spine column: events
    before that second are not part of the history.  ``seen`` names an events column
    that takes the place of ``ts + lag``: the second after which an event is visible,
    no earlier for a later event of the same key.
    """
    by = list(by)
    entry = F.struct(F.col("ts").alias("ts"), *[F.col(c) for c in payload])
    known = reduce(and_, [F.col(c).isNotNull() for c in [*by, "ts"]])
    ev = events.where(known).select(
        *by, (F.col(seen) if seen else F.col("ts") + lag).cast("bigint").alias("_at"), entry.alias("_e"))
    # a second needs no more than its last k events
    per_second = Window.partitionBy(*by, "_at").orderBy(F.col("_e").desc())
    ev = (ev.withColumn("_rn", F.row_number().over(per_second)).where(F.col("_rn") <= k)
            .drop("_rn").withColumn("_b", F.floor(F.col("_at") / bucket)))

    extra = [floor] if floor else []
    moments = spine.where(known).select(*by, "ts", *extra).distinct()
    moments = moments.withColumn("_at", F.col("ts").cast("bigint")).withColumn(
        "_b", F.floor(F.col("_at") / bucket))

    # coarse pass: what each needed bucket inherits
    per_bucket = Window.partitionBy(*by, "_b").orderBy(F.col("_e").desc())
    tops = (ev.select(*by, "_b", "_e").withColumn("_rn", F.row_number().over(per_bucket))
              .where(F.col("_rn") <= k).drop("_rn").withColumn("_kind", F.lit(1)))
    needed = moments.select(*by, "_b").distinct().withColumn("_kind", F.lit(0))
    inherited = _tail(needed.unionByName(tops, allowMissingColumns=True), by, "_b", k)
    inherited = inherited.select(*by, "_b", F.explode("_tail").alias("_e"))

    # fine pass: moments among the events of their own bucket
    rows = (
        moments.withColumn("_kind", F.lit(0))
        .unionByName(ev.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(
            # all before the bucket, in the order of the events
            inherited.withColumn("_kind", F.lit(1))
            .withColumn("_at", F.least(F.col("_e.ts") + F.lit(lag), F.col("_b") * bucket - 1).cast("bigint")),
            allowMissingColumns=True)
    )
    out = _tail(rows, [*by, "_b"], "_at", k)
    hist = F.reverse("_tail")
    if floor:
        hist = F.filter(hist, lambda e: e["ts"] >= F.col(floor))
    return out.select(*by, "ts", hist.alias("hist"))


def point_in_time(spine: DataFrame, events: DataFrame, by=("user_id",), k: int = 10,
                  lag: int = 60, payload=("clue_id",), **kw) -> DataFrame:
    """The same as rows: (by, ts, rn, event_ts, payload...), rn 1 = latest."""
    hist = last_k_before(spine, events, by, k, lag, payload, **kw)
    rows = hist.select(*by, "ts", F.posexplode("hist").alias("_p", "_h"))
    return rows.select(
        *by, "ts", (F.col("_p") + 1).alias("rn"), F.col("_h.ts").alias("event_ts"),
        *[F.col(f"_h.{c}").alias(c) for c in payload])


def union_history_today(history: DataFrame, today: DataFrame) -> DataFrame:
    return history.unionByName(today)


def collect_ordered(rows: DataFrame, keys, rn: str, cols) -> DataFrame:
    """One array per column, ordered by ``rn``, nulls kept.

    One sorted array of structs, split afterwards, instead of one collection
    per column.  Use it on groups already cut to k rows.
    """
    sorted_rows = F.array_sort(F.collect_list(F.struct(rn, *cols)))
    grouped = rows.groupBy(*keys).agg(sorted_rows.alias("_rows"))
    return grouped.select(*keys, *[F.col(f"_rows.{c}").alias(c) for c in cols])


def collect_by_action(rows: DataFrame, keys, rn: str, cols, actions) -> DataFrame:
    """``collect_ordered`` for several actions in one aggregation.

    Gives one array-of-structs column per action, null where there is none.
    """
    entry = F.struct(rn, *cols)
    aggs = [
        F.array_sort(F.collect_list(F.when(F.col("action") == a, entry))).alias(a)
        for a in actions
    ]
    grouped = rows.groupBy(*keys).agg(*aggs)
    return grouped.select(*keys, *[F.when(F.size(a) > 0, F.col(a)).alias(a) for a in actions])


def recent_stats(seqs: DataFrame, cols: dict[str, str], keep=()) -> DataFrame:
    """avg, max, min and p50 over array columns: ``{column: output name format}``."""
    out = []
    for stat, fn in (("avg", array_mean), ("max", F.array_max), ("min", F.array_min),
                     ("p50", lower_median)):
        out += [fn(c).alias(name.format(stat=stat)) for c, name in cols.items()]
    return seqs.select(*keep, *out)


def last_items(spine: DataFrame, events: DataFrame, items: DataFrame, attrs, k: int = 10,
               lag: int = 60, pad=None, floor=None) -> DataFrame:
    """Last k items before each moment with their attributes, padded to k.

    The shortest whole path: history, item join, ordered arrays, padding.
    """
    rows = point_in_time(spine, events, k=k, lag=lag, floor=floor)
    items = items.select("clue_id", *[a for a in attrs if a != "clue_id"])
    joined = sequence_items(rows, items)
    seqs = collect_ordered(joined, ["user_id", "ts"], "rn", attrs)
    if pad is None:
        return seqs
    return seqs.select("user_id", "ts", *[pad_array(a, k, pad).alias(a) for a in attrs])
