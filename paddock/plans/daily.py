"""The daily sample job, and one job for any range of days."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import day_shift
from paddock.operators.filters import SEARCH, only_keys
from paddock.plans import names as N
from paddock.plans.histories import (
    action_events, events_between, history_rows, order_events, sample_sequences, sequence_arrays,
    sequence_attributes, with_sequences,
)
from paddock.plans.items import BY_DAY, item_features, latest_prices, priced_items, prices_by_day
from paddock.plans.samples import train_samples
from paddock.plans.users import sample_user_features
from paddock.session import cut
from paddock.sources.tables import scan_day, scan_days, shift_day

#: Days that one job of a backfill takes together.
DAYS_TOGETHER = 31


def days_between(start: str, end: str) -> list[str]:
    out = []
    while start <= end:
        out.append(start)
        start = shift_day(start, 1)
    return out


@dataclass
class Inputs:
    """The tables of a run.  ``items``, ``rates`` and ``users`` are functions of
    the day, so a source may keep snapshots or derive them.  Items created at
    ``min_create`` (text) or before have no features.

    A range of days asks for the same with a column ``dt``: ``days_of`` names
    functions of the first and last day, by "items", "rates" and "users"; where
    there is none the days are asked one by one and put together.
    """

    behaviour: DataFrame
    orders: DataFrame
    price_log: DataFrame
    dictionary: DataFrame
    items: Callable
    rates: Callable
    users: Callable
    min_create: str
    price_ties: tuple = ()
    days_of: dict | None = None

    def between(self, kind: str, start: str, end: str):
        """The snapshots of ``start`` to ``end`` with their day: a frame, or a tuple of frames."""
        if kind in (self.days_of or {}):
            return self.days_of[kind](start, end)
        days = days_between(start, end)
        found = [getattr(self, kind)(day) for day in days]

        def together(frames):
            return reduce(DataFrame.unionByName, [f.withColumn("dt", F.lit(d)) for d, f in zip(days, frames)])

        if isinstance(found[0], DataFrame):
            return together(found)
        return tuple(together(frames) for frames in zip(*found))


def daily_samples(inputs: Inputs, run_date: str, samples: DataFrame | None = None,
                  as_text: bool = False, scene: str = SEARCH) -> DataFrame:
    """All features of one scene's samples of one day, in one job without step tables.

    Item rates and user features come from the day before.  Only the five key
    columns of the samples are written in between: four joins start from them.
    """
    if samples is None:
        samples = cut(train_samples(scan_day(inputs.behaviour, run_date), scene=scene).drop("dt"))
    before = shift_day(run_date, -1)
    prices = latest_prices(inputs.price_log, run_date, ties=inputs.price_ties)
    items = inputs.items(run_date)
    keys = samples.where(F.col("clue_id").isNotNull())
    out = item_features(
        keys, items, prices, inputs.rates(before), inputs.dictionary, run_date,
        inputs.min_create)
    out = sample_user_features(out, inputs.users(before))
    attributes = sequence_attributes(priced_items(items, prices, run_date), inputs.dictionary)
    events = action_events(inputs.behaviour, run_date).unionByName(
        order_events(inputs.orders, run_date))
    out = sample_sequences(out, events, attributes, as_text, keys_from=keys)
    return out.withColumn("dt", F.lit(run_date))


def _next_day(df: DataFrame) -> DataFrame:
    """Snapshots of a day as what the day after knows."""
    return df.withColumn("dt", day_shift("dt", 1))


def histories_by_day(inputs: Inputs, moments: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(history rows, items by day) of moments of the days ``start`` to ``end``.

    The rows are written once: they say which items are needed on which day, and
    carry the attributes of that day afterwards.
    """
    events = events_between(inputs.behaviour, inputs.orders, start, end)
    rows = cut(history_rows(moments, events))
    asked = rows.select(*BY_DAY).where("clue_id is not null").distinct()
    return rows, _items_on(inputs, asked, start, end)


def _prices_on(inputs: Inputs, asked: DataFrame, start: str, end: str) -> DataFrame:
    """The prices of the asked (dt, clue_id), from the days of the log that can hold them."""
    log = scan_days(inputs.price_log, shift_day(start, -N.PRICE_DAYS), end)
    return prices_by_day(asked, log, ties=inputs.price_ties)


def _snapshots_on(inputs: Inputs, asked: DataFrame, start: str, end: str) -> DataFrame:
    """The snapshot rows of the asked (dt, clue_id).

    Items nobody asks for on any day drop out first: a source that repeats a table for
    every day does so for the others only.
    """
    held = only_keys(inputs.between("items", start, end), "clue_id", asked)
    return asked.join(held, list(BY_DAY))


def _items_on(inputs: Inputs, asked: DataFrame, start: str, end: str) -> DataFrame:
    """The priced snapshot rows of the asked (dt, clue_id)."""
    items = _snapshots_on(inputs, asked, start, end)
    return priced_items(items, _prices_on(inputs, asked, start, end), F.col("dt"), BY_DAY)


def range_sequences(inputs: Inputs, samples: DataFrame, start: str, end: str,
                    as_text: bool = False, keys_from: DataFrame | None = None) -> DataFrame:
    """Samples of many days with sequences as of their own moment and day, in one plan."""
    keys = samples if keys_from is None else keys_from
    rows, priced = histories_by_day(inputs, keys, start, end)
    attributes = sequence_attributes(priced, inputs.dictionary, BY_DAY)
    return with_sequences(samples, sequence_arrays(rows, attributes, BY_DAY), as_text)


def range_samples(inputs: Inputs, start: str, end: str, as_text: bool = False,
                  scene: str = SEARCH) -> DataFrame:
    """The rows :func:`daily_samples` gives for every day from ``start`` to ``end``, in one job.

    Every table is keyed by day: prices and snapshots as of each day, rates and
    users of the day before, histories as of each moment.  The log is scanned once
    for all days and a row is shuffled as often as for one day.
    """
    samples = cut(train_samples(scan_days(inputs.behaviour, start, end), scene=scene))
    keys = samples.where(F.col("clue_id").isNotNull())
    asked = keys.select(*BY_DAY).distinct()
    first, last = shift_day(start, -1), shift_day(end, -1)
    prices = _prices_on(inputs, asked, start, end)
    items = _snapshots_on(inputs, asked, start, end)
    rates = [_next_day(r) for r in inputs.between("rates", first, last)]
    out = item_features(keys, items, prices, rates, inputs.dictionary, F.col("dt"),
                        inputs.min_create, on=BY_DAY)
    out = sample_user_features(out, _next_day(inputs.between("users", first, last)), ["dt", "user_id"])
    return range_sequences(inputs, out, start, end, as_text, keys_from=keys)


def backfill(inputs: Inputs, start: str, end: str, path: str, scene: str = SEARCH,
             together: int = DAYS_TOGETHER, **kw) -> list[str]:
    """Write the samples of a scene for a range of days; days written before are replaced.

    Up to ``together`` days are one job.  Its rows are dealt out by day, a large
    day over several files.
    """
    days = days_between(start, end)
    for low in range(0, len(days), together):
        part = days[low:low + together]
        rows = range_samples(inputs, part[0], part[-1], scene=scene, **kw)
        (rows.withColumn("scene", F.lit(scene)).hint("rebalance", "dt")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt", "scene").parquet(path))
    return days
