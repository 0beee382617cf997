"""Scores and metrics of a labelled range of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import round4
from paddock.operators.evaluate import group_areas, score_pairs, score_ranges
from paddock.operators.ordering import time_split
from paddock.session import cut


def evaluate_scores(scored: DataFrame, group="recommend_id") -> DataFrame:
    """(split, rows, positives, auc, gauc, accuracy) of scored rows with a split."""
    splits = score_ranges(scored)
    whole = group_areas(scored, ["split"], splits)
    per = group_areas(scored, ["split", group], splits).where(F.col("auc").isNotNull())
    grouped = per.groupBy("split").agg(
        round4(F.sum(F.col("auc") * F.col("rows")) / F.sum("rows")).alias("gauc"))
    hit = (F.col("score") > 0.5).cast("int") == F.col("label")
    right = scored.groupBy("split").agg(
        F.round(F.avg(F.when(hit, 1.0).otherwise(0.0)), 3).alias("accuracy"))
    return whole.withColumn("auc", round4("auc")).join(grouped, "split", "left").join(
        right, "split", "left")


def evaluate(samples: DataFrame, users: DataFrame, items: DataFrame, shares=(0.8, 0.1, 0.1),
             group="recommend_id") -> DataFrame:
    """Time split, inner product scores, and the metrics of each part."""
    scored = score_pairs(users, items, time_split(samples, shares))
    return evaluate_scores(cut(scored.select("split", group, "label", "score")), group)
