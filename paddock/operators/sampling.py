"""Negatives: for each request one random item among those already on sale.

Joining requests to every earlier item makes as many pairs as both counts
multiplied.  The random item is drawn by number instead: items are numbered in
order of their first appearance, a request at time t may draw numbers below
n(t), the count of items that appeared before t, and the drawn number is joined
back to its item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import hash32, keep_draw, unit_draw
from paddock.operators.joins import lookup_join

HOUR = 3600
#: Items of one second that are numbered together, about.
PART_ROWS = 100_000
ORDER_SEED = "order"


def _earlier(value: str, by, order: str):
    """The sum of ``value`` over the rows before, per ``by``."""
    rows = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def _seconds(queries: DataFrame, items: DataFrame, day: str) -> DataFrame:
    """(day, _sec, _cnt, _base): items per second, and items of the day before it.

    Sums run over the seconds of one hour and the hours of one day.
    """
    marks = items.groupBy(day, F.col("on_sale_ts").alias("_sec")).agg(F.count("*").alias("_cnt"))
    asked = queries.select(day, F.col("query_ts").alias("_sec"), F.lit(0).cast("bigint").alias("_cnt"))
    both = marks.unionByName(asked.distinct()).groupBy(day, "_sec").agg(F.sum("_cnt").alias("_cnt"))
    both = both.withColumn("_hour", F.floor(F.col("_sec") / HOUR))
    hours = both.groupBy(day, "_hour").agg(F.sum("_cnt").alias("_in"))
    hours = hours.select(day, "_hour", _earlier("_in", [day], "_hour").alias("_off"))
    both = both.withColumn("_run", _earlier("_cnt", [day, "_hour"], "_sec")).join(hours, [day, "_hour"])
    return both.select(day, "_sec", "_cnt", (F.col("_run") + F.col("_off")).alias("_base"))


def eligible_index(queries: DataFrame, items: DataFrame, day: str = "dt"):
    """(queries with ``n``, items with ``idx``), both per day.

    ``n`` is the number of items with ``on_sale_ts < query_ts``; ``idx`` counts
    items from 0 by (on_sale_ts, hash of clue_id, clue_id).  The order is found from
    the top: hours of a day, seconds of an hour, parts of a second, items of a part.
    A second is cut into ranges of the hash by its measured count, so a day whose
    items all appear at once is numbered by as many tasks as it has parts.
    """
    seconds = _seconds(queries, items, day)
    columns = items.columns
    items = items.withColumns({"_sec": F.col("on_sale_ts"), "_hash": hash32(ORDER_SEED, "clue_id")})
    items = lookup_join(items, seconds.where("_cnt > 0"), [day, "_sec"], "inner")
    parts = F.ceil(F.col("_cnt") / PART_ROWS)
    items = items.withColumn("_part", F.floor(F.col("_hash") * parts / F.lit(float(2**32))))
    slot = [day, "_sec", "_part"]
    cut = items.where(F.col("_cnt") > PART_ROWS).groupBy(*slot).agg(F.count("*").alias("_own"))
    cut = cut.select(*slot, _earlier("_own", [day, "_sec"], "_part").alias("_off"))
    inside = F.row_number().over(Window.partitionBy(*slot).orderBy("_hash", "clue_id"))
    numbered = lookup_join(items, cut, slot).withColumn(
        "idx", F.col("_base") + F.coalesce(F.col("_off"), F.lit(0)) + inside - 1)

    counts = seconds.select(day, F.col("_sec").alias("query_ts"), F.col("_base").alias("n"))
    return lookup_join(queries, counts, [day, "query_ts"]), numbered.select(*columns, "idx")


def eligible_items(queries: DataFrame, items: DataFrame, day: str = "dt") -> DataFrame:
    """Requests with the number of items they may be joined to."""
    return eligible_index(queries, items, day)[0]


def pick_query(queries: DataFrame, group, seed) -> DataFrame:
    """One user's row per group, with weight max(n, 1): the user's share of the pairs."""
    draw = -F.log(unit_draw(seed, *group, "user_id")) / F.greatest(F.col("n"), F.lit(1))
    rest = [c for c in queries.columns if c not in group]
    best = F.min(F.struct(draw.alias("_d"), F.col("user_id").alias("_u"), *[
        F.col(c) for c in rest]))
    out = queries.groupBy(*group).agg(best.alias("_b"))
    return out.select(*group, *[F.col(f"_b.{c}").alias(c) for c in rest])


def sampled_negatives(queries: DataFrame, items: DataFrame, rate: float = 0.3, seed: int = 1,
                      day: str = "dt") -> DataFrame:
    """One random eligible item for a share ``rate`` of the (request, page) groups.

    A request before the first item keeps a null item.
    """
    counted, numbered = eligible_index(queries, items, day)
    group = [day, "recommend_id", "page"]
    chosen = pick_query(counted, group, f"{seed}-user")
    chosen = chosen.where(keep_draw(rate, f"{seed}-keep", *group, "user_id"))
    number = F.when(
        F.col("n") > 0, F.pmod(hash32(f"{seed}-item", *group, "user_id"), F.col("n")))
    chosen = chosen.withColumn("idx", number)
    # while few items are on sale all requests draw from those few: a hot key like any other
    numbered = numbered.select(day, "idx", "clue_id")
    return lookup_join(chosen, numbered, [day, "idx"]).drop("idx", "n")


def bernoulli(df: DataFrame, p: float, seed, keys) -> DataFrame:
    """Keep a key tuple, with all its rows, with probability ``p``."""
    return df.where(keep_draw(p, seed, *keys))


def union_labels(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    return positives.unionByName(negatives)
