"""Exact quantiles of many features without sorting their values.

A mergeable sketch gives, for every asked rank of every feature at once, two values
that enclose it.  One more scan counts what lies below and lists the values between
them, and the value at the rank is read off those.  Between very many values, sketches
of what lies between narrow them first.  The counts are exact, so a sketch that was
off is noticed and costs another scan, never a wrong result.

What reaches the driver is a row per feature and asked rank.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a sketch, its relative error as one in so many, and values listed at most.
POINTS, ACCURACY, LISTED = 128, 5_000, 200_000


@dataclass
class Rank:
    """An asked rank of a feature, with values known to enclose it and about how many lie between."""

    feature: str
    at: int
    low: float
    high: float
    between: float
    value: float | None = None


def sketched(value: Column) -> Column:
    shares = F.from_json(F.lit(str([i / POINTS for i in range(1, POINTS)])), "array<double>")
    return F.percentile_approx(value, shares, ACCURACY)


def _enclosed(feature: str, at: int, n: int, points: list, offset: int = 0) -> Rank:
    """The nearest sketch points that enclose rank ``at``, for a sketch of ``n`` values that
    starts with its least and ends with its greatest."""
    error = 4 * n / ACCURACY + 1
    ranks = [offset + i * n / POINTS for i in range(POINTS + 1)]
    i = max((i for i in range(1, POINTS) if ranks[i] + error <= at), default=0)
    j = min((j for j in range(i + 1, POINTS) if ranks[j] - error >= at), default=POINTS)
    low, high = points[i], points[j]
    i = max(k for k in range(POINTS + 1) if points[k] == low)
    j = min(k for k in range(POINTS + 1) if points[k] == high)
    return Rank(feature, at, low, high, max(0, j - i) * n / POINTS + 2 * error if low < high else 0)


def _beside(values: DataFrame, ranks: list[Rank]) -> DataFrame:
    """Every value beside the ranks of its feature: a constant of a few entries per feature."""
    asked: dict = {}
    for k, r in enumerate(ranks):
        asked.setdefault(r.feature, []).append({"k": k, "at": r.at, "low": r.low, "high": r.high})
    held = F.from_json(F.lit(json.dumps(asked)), "map<string,array<struct<k:int,at:bigint,low:double,high:double>>>")
    rows = values.select("value", F.explode(F.element_at(held, F.col("feature"))).alias("r"))
    return rows.select("value", "r.*")


def _list(values: DataFrame, ranks: list[Rank]) -> None:
    """Find the ranks with few values between their bounds."""
    key = F.when(F.col("value") >= F.col("low"), F.col("value"))
    counted = _beside(values, ranks).where("value <= high").groupBy("k", "at", key.alias("v")).agg(
        F.count("*").alias("c"))
    upto = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    held = counted.withColumn("s", F.sum("c").over(upto)).where("s > at and s - c <= at")
    found = {r.k: r.v for r in held.select("k", "v").collect()}
    for k, r in enumerate(ranks):
        if found.get(k) is not None:
            r.value = found[k]
        elif k in found:
            r.low, r.high, r.between = -math.inf, r.low, math.inf
        else:
            r.low, r.high, r.between = r.high, math.inf, math.inf


def _narrow(values: DataFrame, ranks: list[Rank]) -> None:
    """Move the bounds of ranks closer, or find them at a bound."""
    inner = F.when((F.col("value") > F.col("low")) & (F.col("value") < F.col("high")), F.col("value"))
    rows = _beside(values, ranks).groupBy("k").agg(
        F.count_if(F.col("value") < F.col("low")).alias("below"),
        F.count_if(F.col("value") == F.col("low")).alias("at_low"),
        F.count_if(F.col("value") == F.col("high")).alias("at_high"),
        F.count(inner).alias("n"), F.min(inner).alias("least"), F.max(inner).alias("most"),
        sketched(inner).alias("points")).collect()
    for row in rows:
        r = ranks[row.k]
        ends = [row.below, row.below + row.at_low]
        ends += [ends[-1] + row.n, ends[-1] + row.n + row.at_high]
        if r.at < ends[0]:
            r.low, r.high, r.between = -math.inf, r.low, math.inf
        elif r.at < ends[1]:
            r.value = r.low
        elif r.at < ends[2]:
            new = _enclosed(r.feature, r.at, row.n, [row.least, *row.points, row.most], ends[1])
            r.low, r.high, r.between = new.low, new.high, new.between
        elif r.at < ends[3]:
            r.value = r.high
        else:
            r.low, r.high, r.between = r.high, math.inf, math.inf


def exact_quantiles(values: DataFrame, probs) -> DataFrame:
    """(feature, n, p, value): interpolated quantiles of (feature, value) rows.

    Nulls and NaN do not count; a feature without values has no row.  The result is
    a small local table.
    """
    values = values.where("value is not null and not isnan(value)").select("feature", "value")
    rows = values.groupBy("feature").agg(
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"),
        sketched(F.col("value")).alias("points")).collect()
    ranks = {}
    for row in rows:
        for p in probs:
            at = float(p) * (row.n - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                ranks[row.feature, rank] = _enclosed(row.feature, rank, row.n, [row.least, *row.points, row.most])
    while open_ := [r for r in ranks.values() if r.value is None]:
        few = [r for r in open_ if r.between <= LISTED]
        if few:
            _list(values, few)
        if len(few) < len(open_):
            _narrow(values, [r for r in open_ if r.between > LISTED and r.value is None])
    out = []
    for row in rows:
        for p in probs:
            at = float(p) * (row.n - 1)
            low, high = ranks[row.feature, math.floor(at)].value, ranks[row.feature, math.ceil(at)].value
            out.append((row.feature, row.n, float(p), low + (at - math.floor(at)) * (high - low)))
    columns = list(zip(*out)) or [[], [], [], []]
    kinds = {"feature": pa.string(), "n": pa.int64(), "p": pa.float64(), "value": pa.float64()}
    return values.sparkSession.createDataFrame(
        pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, kinds.items())}))


def long_values(df: DataFrame, cols=(), seqs=()) -> DataFrame:
    """(feature, value) rows of scalar columns and of all sequence elements."""
    scalars = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ]

    def elements(s):
        known = F.coalesce(F.col(s).cast("array<double>"), F.array().cast("array<double>"))
        return F.transform(known, lambda x: F.struct(F.lit(s).alias("feature"), x.alias("value")))

    none = F.array().cast("array<struct<feature:string,value:double>>")
    every = F.concat(none, *([F.array(*scalars)] if scalars else []), *[elements(s) for s in seqs])
    return df.select(F.explode(every).alias("_v")).select("_v.feature", "_v.value")


def fit_medians(df: DataFrame, dense=(), seqs=()) -> DataFrame:
    """Exact interpolated medians: per column, and per sequence over all its elements."""
    return exact_quantiles(long_values(df, dense, seqs), [0.5]).select(
        "feature", F.col("value").alias("median"))


def fit_trimmed_scaler(df: DataFrame, cols, p: float = 0.03) -> DataFrame:
    """(feature, mean, scale) over the values within the p and 1-p quantiles."""
    values = long_values(df, cols).where(F.col("value").isNotNull())
    bounds = exact_quantiles(values, [p, 1 - p]).groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    # one row per column
    kept = values.join(F.broadcast(bounds), "feature").where(
        F.col("value").between(F.col("lo"), F.col("hi")))
    out = kept.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("scale"))
    return out.withColumn("scale", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")))
