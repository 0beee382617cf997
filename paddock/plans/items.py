"""Item features: snapshot, latest price, rates of the day before, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import (
    diff_price, level_ordinal, on_shelf_days, price_bin, safe_int, score_segment,
    year_from_title,
)
from paddock.operators.encoding import encode_categories
from paddock.operators.filters import on_sale, recent_items
from paddock.operators.joins import (
    join_item_features, join_item_rates, join_latest_price,
)
from paddock.operators.windows import latest_per_key
from paddock.plans import names as N
from paddock.sources.tables import scan_window


PRICES = ("model_price", "seller_price", "car_level")
#: Keys of tables that hold the items of many days.
BY_DAY = ("dt", "clue_id")


def latest_prices(price_log: DataFrame, run_date: str, days: int = N.PRICE_DAYS,
                  ties=()) -> DataFrame:
    """The latest price row per item over the lookback, as int."""
    window = scan_window(price_log, run_date, -days, 0)
    last = latest_per_key(window, "clue_id", ties=ties)
    return last.select(*[
        safe_int(c).alias(c) for c in ("clue_id", *PRICES)
    ])


def prices_by_day(asked: DataFrame, price_log: DataFrame, days: int = N.PRICE_DAYS,
                  ties=()) -> DataFrame:
    """(dt, clue_id, model_price, seller_price, car_level): the row that
    :func:`latest_prices` gives each asked day and item.

    ``asked`` holds distinct (dt, clue_id).  Each day of an item keeps its last row,
    so the ordered pass per item is over days, however many rows an item has; the
    price of an asked day is the last before it.  Of the log only the days that some
    asked day looks back on are read.
    """
    marks = asked.select("clue_id", "dt", F.lit(1).alias("_asked"))
    first = asked.agg(F.date_sub(F.min("dt").cast("date"), days).cast("string")).scalar()
    within = price_log.where((F.col("dt") >= first) & (F.col("dt") <= asked.agg(F.max("dt")).scalar()))
    rows = within.withColumn("clue_id", safe_int("clue_id")).where("clue_id is not null")
    rows = latest_per_key(rows, ["clue_id", "dt"], ties=ties).select(
        "clue_id", "dt", F.lit(0).alias("_asked"),
        F.struct("dt", *[safe_int(c).alias(c) for c in PRICES]).alias("_last"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy("clue_id").orderBy("dt", "_asked")
    seen = both.withColumn("_last", F.last("_last", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))).where("_asked = 1")
    recent = F.col("_last.dt") >= F.date_sub(F.col("dt").cast("date"), days).cast("string")
    return seen.select("dt", "clue_id", *[F.when(recent, F.col(f"_last.{c}")).alias(c) for c in PRICES])


def priced_items(items: DataFrame, prices: DataFrame, run_date, on=("clue_id",)) -> DataFrame:
    """Snapshot rows with price, segments and bins; one row per item.

    Tables of many days are joined ``on`` the day too; ``run_date`` is a day or,
    for those, the column that holds it.
    """
    out = join_latest_price(items, prices, list(on))
    return out.withColumns({
        "diff_price": diff_price(),
        "on_shelf_days": on_shelf_days(run_date),
        "evaluate_level_segment": level_ordinal("evaluate_level"),
        "evaluate_score_segment": score_segment("evaluate_score"),
        "model_price_bin": price_bin("model_price"),
    })


def item_table(items: DataFrame, prices: DataFrame, rates, dictionary: DataFrame, run_date,
               names: dict | None = None, on=("clue_id",)) -> DataFrame:
    """(clue_id, s_i..., d_i...): all item features, encoded; by day with :data:`BY_DAY`.

    ``rates`` are frames of the day before.  ``names`` replaces dictionary
    names, which differ between versions.
    """
    on = list(on)
    priced = join_item_rates(priced_items(items, prices, run_date, on), *rates, on=on)
    named = priced.select(
        *on,
        *[F.col(a).alias(f) for a, f, _ in N.ITEM_SPARSE],
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(f) for c, f in N.ITEM_RATES.items()],
        *[F.col(c).alias(f) for c, f in N.ITEM_DENSE.items()],
    )
    names = names or {}
    specs = {f: names.get(d, d) for _, f, d in N.ITEM_SPARSE}
    return encode_categories(named, specs, dictionary, key=on)


def item_features(samples: DataFrame, items: DataFrame, prices: DataFrame, rates,
                  dictionary: DataFrame, run_date, min_create: str,
                  names=None, on=("clue_id",)) -> DataFrame:
    """Samples with a known item id and the features of their item.

    Samples whose item is not in the table get 1 for the sparse features and
    null for the dense ones.
    """
    table = item_table(recent_items(items, min_create), prices, rates, dictionary, run_date, names, on)
    out = join_item_features(samples.where(F.col("clue_id").isNotNull()), table, on)
    sparse = {f for _, f, _ in N.ITEM_SPARSE}
    return out.select(*[
        F.coalesce(F.col(c), F.lit(1)).alias(c) if c in sparse else F.col(c) for c in out.columns
    ])


def sale_items(sale: DataFrame) -> DataFrame:
    """Items on sale as snapshot rows; the year comes from the title."""
    return on_sale(sale).withColumn("car_year", year_from_title("title"))
