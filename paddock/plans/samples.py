"""Labelled samples from the behaviour log.

Each job takes the log of any number of days, so a range of days is one Spark
job and a single day is the same job on one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import price_reached
from paddock.functions.scalars import PRICE_SHARES
from paddock.operators.aggregates import distinct_rows, first_seen, query_heads
from paddock.operators.filters import (
    SEARCH, filter_actions, filter_named_scene, filter_scene, int_ids, valid_ids,
)
from paddock.operators.joins import attach_labels, lookup_join
from paddock.operators.sampling import sampled_negatives, union_labels
from paddock.operators.windows import first_per_key

SAMPLE_COLUMNS = ("dt", "user_id", "clue_id", "recommend_id", "label", "ts")
NEGATIVE_RATE = 0.3
LABEL_ACTIONS = ("beseen", "click", "quick_collection", "bid")
ORDER_AHEAD_DAYS = 3


def requests_and_items(behaviour: DataFrame, scene: str = SEARCH):
    """(request heads, items on sale) of each day in a scene."""
    scene = filter_named_scene(behaviour, scene)
    items = int_ids(valid_ids(scene, ["clue_id"]), ["clue_id", "ts"])
    items = first_seen(items, by=["dt"])
    seen = valid_ids(filter_actions(scene, ["beseen"]), ["user_id", "clue_id"])
    seen = int_ids(seen.where(F.col("recommend_id") != ""), ["user_id", "ts"])
    heads = query_heads(seen, ("dt", "user_id", "recommend_id", "page"))
    return heads, items


def positives(behaviour: DataFrame, scene: str = SEARCH) -> DataFrame:
    """Distinct bids: the positive pairs."""
    bids = valid_ids(filter_actions(filter_named_scene(behaviour, scene), ["bid"]), ["user_id", "clue_id"])
    bids = int_ids(bids.where(F.col("recommend_id") != ""), ["user_id", "clue_id", "ts"])
    rows = distinct_rows(bids, ["dt", "user_id", "clue_id", "recommend_id", "ts"])
    return rows.withColumn("label", F.lit(1)).select(*SAMPLE_COLUMNS)


def train_samples(behaviour: DataFrame, rate: float = NEGATIVE_RATE, seed: int = 1,
                  scene: str = SEARCH) -> DataFrame:
    """Positive bids and, for a share of the requests, one random item on sale.

    A request before the first item of its day gives a null item, as a left
    join would; feature jobs drop it.
    """
    heads, items = requests_and_items(behaviour, scene)
    negatives = sampled_negatives(heads, items, rate, seed)
    negatives = negatives.select(
        "dt", "user_id", "clue_id", "recommend_id", F.lit(0).alias("label"),
        F.col("query_ts").alias("ts"))
    return union_labels(positives(behaviour, scene), negatives)


def label_events(behaviour: DataFrame) -> DataFrame:
    """The earliest row per day and (item, user, request, action) in the search scene."""
    df = valid_ids(filter_scene(behaviour), ["user_id"], above_zero=False,
                   not_values=("0", "unknown"))
    df = df.where((F.col("recommend_id") != "") & (F.col("clue_id") != ""))
    df = int_ids(filter_actions(df, LABEL_ACTIONS), ["user_id", "clue_id", "ts"])
    df = df.withColumn("amount", F.expr("try_cast(try_cast(amount as double) as int)"))
    return first_per_key(
        df, ["dt", "clue_id", "user_id", "recommend_id", "action"], ties=["amount"])


def label_flags(events: DataFrame, prices: DataFrame, by_user: bool = False) -> DataFrame:
    """One row of flags per (day, item, request) from one aggregation.

    ``prices``: (dt, clue_id, model_price), the latest price as of each day.

    The key leaves the user out, as times reported by clients are not exact but
    requests are; where users share a request this gives one flag and not one
    row per user.  ``by_user`` adds the user to the key.
    """
    priced = lookup_join(events.where("action <> 'beseen'"),
                         prices.select("dt", "clue_id", "model_price"), ["dt", "clue_id"])
    bid = F.col("action") == "bid"
    flags = {f"is_{a}": (F.col("action") == a).cast("int") for a in LABEL_ACTIONS[1:]}
    flags.update({
        name: F.when(bid, price_reached(share)).otherwise(0)
        for name, share in PRICE_SHARES.items()
    })
    keys = ["dt", "clue_id", "recommend_id"] + (["user_id"] if by_user else [])
    return priced.groupBy(*keys).agg(*[F.max(c).alias(n) for n, c in flags.items()])


def order_flags(orders: DataFrame, days: DataFrame, ahead: int = ORDER_AHEAD_DAYS) -> DataFrame:
    """(dt, clue_id, user_id, is_order) for orders on a day or up to ``ahead`` days later.

    ``days``: (dt), the days of the log; other orders drop out before they are multiplied.
    """
    made = F.substring("create_time", 1, 10).cast("date")
    span = days.agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    orders = orders.where((made >= first.cast("date")) & (made <= F.date_add(last.cast("date"), ahead)))
    days = F.sequence(F.date_sub(made, ahead), made)
    return orders.select(
        F.explode(F.transform(days, lambda d: d.cast("string"))).alias("dt"), "clue_id", "user_id"
    ).distinct().withColumn("is_order", F.lit(1))


def impression_labels(behaviour: DataFrame, prices: DataFrame, orders: DataFrame,
                      by_user: bool = False) -> DataFrame:
    """Impressions with their click, collection, bid, price and order labels.

    ``prices`` holds the latest price per day and item, ``orders`` int ids and
    the time of each order.  Every day is labelled by itself: a range of days
    gives the rows of its days.
    """
    events = label_events(behaviour)
    seen = events.where("action = 'beseen'").select(
        "dt", "clue_id", "user_id", "recommend_id", "ts")
    keys = ["dt", "clue_id", "recommend_id"] + (["user_id"] if by_user else [])
    out = attach_labels(seen, label_flags(events, prices, by_user), keys)
    flags = order_flags(orders, behaviour.select("dt"))
    out = attach_labels(out, flags, ["dt", "clue_id", "user_id"])
    return out.select(
        "dt", "clue_id", "user_id", "recommend_id", "ts", "is_click", "is_quick_collection",
        "is_bid", *PRICE_SHARES, "is_order")


def test_samples(impressions: DataFrame, label: str = "is_bid") -> DataFrame:
    """Impressions as samples, labelled by one of their flags."""
    return impressions.select(
        "dt", "user_id", "clue_id", "recommend_id", F.col(label).alias("label"), "ts")
