"""Offline evaluation of scored samples.

Areas under the curve come from counts per distinct score: a sketch of all scores
parts them into ranges, ranks run inside a range of a group, and equal scores share
their average rank.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions import dot, sigmoid
from paddock.operators.joins import lookup_join

#: Rows of a score range, about, and how many ranges there are at most.
PER_RANGE, MOST_RANGES = 1_000_000, 4096


def score_ranges(df: DataFrame, score="score") -> list[float]:
    """Scores that part all rows into ranges of about ``PER_RANGE``; none for few rows.

    Rows are counted; where there are many, one sketch gives the scores.
    """
    wanted = min(MOST_RANGES, -(-df.count() // PER_RANGE))
    if wanted < 2:
        return []
    shares = [i / wanted for i in range(1, wanted)]
    found = df.agg(F.percentile_approx(F.col(score).cast("double"), shares).alias("q")).first()["q"]
    return sorted(set(found or []))


def _range_of(score, splits: list[float]):
    """How many of the sorted ``splits`` lie below a score, looked up in two steps."""
    if not splits:
        return F.lit(0)
    step = max(1, math.isqrt(len(splits)))
    below = lambda points: F.size(F.filter(points, lambda s: s < score))
    coarse = below(F.array(*[F.lit(s) for s in splits[step - 1::step]]))
    return coarse * step + below(F.slice(F.array(*[F.lit(s) for s in splits]), coarse * step + 1, F.lit(step)))


def group_areas(df: DataFrame, by, splits: list[float], label="label", score="score") -> DataFrame:
    """(by..., rows, positives, auc); auc is null where one label is missing.

    Ranks run inside a (group, score range) only; a group of any size spreads over
    the ranges, and its ranges are added up in order.
    """
    by = list(by)
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    own = _range_of(F.col(score).cast("double"), splits)
    counted = df.groupBy(*by, own.alias("_range"), F.col(score).alias("_score")).agg(
        F.count("*").alias("_all"), pos.alias("_pos"))
    counted = counted.withColumn("_neg", F.col("_all") - F.col("_pos"))
    upto = Window.partitionBy(*by, "_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, 0)
    # negatives below count 1, ties count one half
    wins = F.col("_pos") * (F.sum("_neg").over(upto) - F.col("_neg") / 2)
    part = counted.withColumn("_w", wins).groupBy(*by, "_range").agg(
        F.sum("_all").alias("_all"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.sum("_w").alias("_w"))
    # no more entries than there are ranges
    ranges = F.array_sort(F.collect_list(F.struct("_range", "_pos", "_neg", "_w")))
    start = F.struct(F.lit(0).cast("long").alias("neg"), F.lit(0.0).alias("w"))
    total = F.aggregate(ranges, start, lambda a, r: F.struct(
        (a["neg"] + r["_neg"]).alias("neg"), (a["w"] + r["_w"] + r["_pos"] * a["neg"]).alias("w")))
    out = part.groupBy(*by).agg(
        F.sum("_all").alias("rows"), F.sum("_pos").alias("positives"), total["w"].alias("_w"))
    pairs = F.col("positives") * (F.col("rows") - F.col("positives"))
    return out.select(
        *by, "rows", "positives", F.when(pairs > 0, F.col("_w") / pairs).alias("auc"))


def _group_auc(df: DataFrame, by, label="label", score="score") -> DataFrame:
    return group_areas(df, by, score_ranges(df, score), label, score)


def auc(df: DataFrame, label="label", score="score") -> DataFrame:
    """One row: rows, positives, auc."""
    return _group_auc(df, [], label, score)


def group_auc(df: DataFrame, group, label="label", score="score") -> DataFrame:
    """One row per group."""
    return _group_auc(df, [group] if isinstance(group, str) else group, label, score)


def gauc(df: DataFrame, group="recommend_id", label="label", score="score",
         one_label=None) -> DataFrame:
    """One row: the mean of the groups' areas weighted by their rows, 4 digits.

    Groups with one label only do not count; null if no group is left.  The
    training monitor reports ``one_label=0.5`` where all samples share a label.
    """
    per = group_auc(df, group, label, score)
    mixed = F.col("auc").isNotNull()
    area = F.sum(F.when(mixed, F.col("auc") * F.col("rows"))) / F.sum(F.when(mixed, F.col("rows")))
    value = F.round(area, 4)
    if one_label is not None:
        positives = F.sum("positives")
        single = (positives == 0) | (positives == F.sum("rows"))
        value = F.when(single, F.lit(float(one_label))).otherwise(value)
    return per.agg(F.count_if(mixed).alias("groups"), value.alias("gauc"))


def accuracy(df: DataFrame, threshold: float = 0.5, label="label", score="score") -> DataFrame:
    hit = (F.col(score) > threshold).cast("int") == F.col(label)
    return df.agg(F.round(F.avg(F.when(hit, 1.0).otherwise(0.0)), 3).alias("accuracy"))


def score_pairs(users: DataFrame, items: DataFrame, pairs: DataFrame, user="user_id",
                item="clue_id", user_vec="user_embedding", item_vec="item_embedding") -> DataFrame:
    """Inner product and its sigmoid for every pair with both vectors."""
    narrow_u = users.select(user, F.col(user_vec).alias("_u"))
    narrow_i = items.select(item, F.col(item_vec).alias("_i"))
    both = lookup_join(pairs, narrow_u, user, "inner")
    both = lookup_join(both, narrow_i, item, "inner")
    both = both.withColumn("inner_product", dot("_u", "_i"))
    return both.withColumn("score", sigmoid("inner_product")).drop("_u", "_i")


def daily_auc(df: DataFrame, day="dt", group="recommend_id", label="label",
              score="score") -> DataFrame:
    """One row per day: rows, positives, auc and the group-weighted area, 4 digits."""
    splits = score_ranges(df, score)
    whole = group_areas(df, [day], splits, label, score)
    per = group_areas(df, [day, group], splits, label, score).where(F.col("auc").isNotNull())
    grouped = per.groupBy(day).agg(
        F.round(F.sum(F.col("auc") * F.col("rows")) / F.sum("rows"), 4).alias("gauc"))
    return whole.join(grouped, day, "left").select(
        day, "rows", "positives", F.round("auc", 4).alias("auc"), "gauc")


def experiment_lift(df: DataFrame, arm="arm", control="control", test="test",
                    user="user_id", item="clue_id") -> DataFrame:
    """Relative lift of each action between two arms, at three grains.

    pv: rows; pair: distinct (user, item); item: distinct items.  Distinct keys
    are reduced first, so each grain is a plain count afterwards.
    """
    rows = df.groupBy("action", arm, user, item).agg(F.count("*").alias("_n"))
    pairs = rows.groupBy("action", arm, item).agg(
        F.sum("_n").alias("_n"), F.count("*").alias("_pairs"))
    per = pairs.groupBy("action").agg(*[
        F.sum(F.when(F.col(arm) == a, F.col(c) if c else F.lit(1)).otherwise(0))
        .alias(f"{a}_{g}")
        for a in (control, test) for g, c in (("pv", "_n"), ("pair", "_pairs"), ("item", None))
    ])
    return per.select(
        "action",
        *[F.col(f"{a}_{g}") for a in (control, test) for g in ("pv", "pair", "item")],
        *[F.expr(f"round(try_divide({test}_{g} - {control}_{g}, {control}_{g}), 6)")
          .alias(f"lift_{g}") for g in ("pv", "pair", "item")],
    )
