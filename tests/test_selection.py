"""Quantiles, areas and cuts found by counting: small limits, so that every step is taken."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import evaluate as M
from paddock.operators import ordering as O
from paddock.operators import quantiles as Q


def quantile(vs, p):
    vs = sorted(vs)
    at = p * (len(vs) - 1)
    low = int(at)
    return vs[low] + (at - low) * (vs[min(low + 1, len(vs) - 1)] - vs[low])


def values():
    rnd = random.Random(11)
    return {
        "hot": [1.0] * 700 + [1.0 + rnd.random() for _ in range(300)],
        "edge": [5.0] * 501 + [6.0 + i for i in range(500)],
        "spread": [rnd.gauss(0, 1e6) for _ in range(999)],
        "one": [3.5], "two": [-1.0, 4.0], "same": [2.0] * 50,
        "tiny": [rnd.random() * 1e-300 for _ in range(40)],
    }


@pytest.mark.parametrize("points,listed", [(128, 200_000), (8, 40), (4, 0)])
def test_quantiles_of_many_features_at_once(spark, monkeypatch, points, listed):
    monkeypatch.setattr(Q, "POINTS", points)
    monkeypatch.setattr(Q, "LISTED", listed)
    data, probs = values(), (0.0, 0.03, 0.5, 0.97, 1.0)
    rows = [(f, v) for f, vs in data.items() for v in vs] + [("hot", None), ("one", float("nan")), ("none", None)]
    got = {(r.feature, r.p): (r.n, r.value) for r in Q.exact_quantiles(
        spark.createDataFrame(rows, "feature string, value double").repartition(3), probs).collect()}
    assert got == {(f, p): (len(vs), pytest.approx(quantile(vs, p))) for f, vs in data.items() for p in probs}


def test_a_sketch_that_is_off_costs_a_scan_and_no_result(spark, monkeypatch):
    def off(feature, at, n, points, offset=0, calls=itertools.count()):
        wrong = next(calls) < 14  # bounds above, below, and on the wrong side of a point
        low, high = ((points[0], points[1]), (points[-2], points[-1]), (points[3], points[3]))[at % 3] if wrong else (points[0], points[-1])
        return Q.Rank(feature, at, low, high, 10)

    monkeypatch.setattr(Q, "_enclosed", off)
    data = values()
    rows = [(f, v) for f, vs in data.items() for v in vs]
    got = {r.feature: r.value for r in Q.exact_quantiles(
        spark.createDataFrame(rows, "feature string, value double"), [0.4]).collect()}
    assert got == {f: pytest.approx(quantile(vs, 0.4)) for f, vs in data.items()}


def test_no_values_no_rows(spark):
    empty = spark.createDataFrame([], "feature string, value double")
    assert Q.exact_quantiles(empty, [0.5]).count() == 0
    assert Q.fit_medians(spark.createDataFrame([(None,)], "x double"), ["x"]).count() == 0


def pair_auc(rows):
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    if not pos or not neg:
        return None
    return sum((p > q) + .5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_range", [1_000_000, 7, 1])
def test_areas_by_ranges_of_scores(spark, monkeypatch, per_range):
    monkeypatch.setattr(M, "PER_RANGE", per_range)
    rnd = random.Random(12)
    rows = [(rnd.choice("aaab"), rnd.randint(0, 1), rnd.choice([0.5, 0.5, rnd.random() ** 4, -rnd.random()])) for _ in range(600)]
    rows += [("c", 1, 0.25), ("d", 0, 0.1), ("d", 1, 0.1)]
    df = spark.createDataFrame(rows, "recommend_id string, label int, score double")
    assert len(M.score_ranges(df)) == (0 if per_range > 600 else len(M.score_ranges(df)))
    assert per_range > 600 or len(M.score_ranges(df)) > 20
    assert M.auc(df).first()["auc"] == pytest.approx(pair_auc([(y, s) for _, y, s in rows]))
    for r in M.group_auc(df, "recommend_id").collect():
        own = [(y, s) for g, y, s in rows if g == r.recommend_id]
        want = pair_auc(own)
        assert (r.rows, r.positives) == (len(own), sum(y for y, _ in own))
        assert r.auc == (None if want is None else pytest.approx(want))


def test_ranges_of_scores_are_looked_up_in_two_steps(spark):
    splits = [float(i) for i in range(50)]
    df = spark.createDataFrame([(x / 4 - 1,) for x in range(220)], "s double")
    for n in (0, 1, 2, 3, 9, 10, 50):
        got = df.select("s", M._range_of(F.col("s"), splits[:n]).alias("r")).collect()
        assert all(r.r == sum(p < r.s for p in splits[:n]) for r in got)


KEYS = ("ts", "user_id", "clue_id", "recommend_id")


def split_of(rows, shares=(.8, .1, .1)):
    """The split of each row in order; rows of equal keys may change places."""
    rows = sorted(rows, key=lambda r: tuple((x is not None, x or 0 if not isinstance(x, str) else x) for x in r))
    n = len(rows)
    cuts = [int(n * round(sum(shares[:k + 1]), 10)) for k in range(len(shares) - 1)]
    names = ("train", "valid", "test")
    return sorted((str(r), names[sum(i >= c for c in cuts)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("listed", [1_000_000, 30])
def test_cuts_in_a_hot_second_with_nulls_and_copies(spark, monkeypatch, listed):
    monkeypatch.setattr(O, "LISTED", listed)
    rnd = random.Random(13)
    for hot in (0.9, 0.3, 0.0):
        rows = [(50 if rnd.random() < hot else rnd.randint(0, 100), rnd.choice([None, 1, 2, rnd.randint(3, 40)]),
                 rnd.choice([None, 7, rnd.randint(0, 9)]), rnd.choice([None, "r", "s"])) for _ in range(500)]
        rows += [(None, 1, 1, "r")] * 3 + [(50, 2, 7, "r")] * 60
        df = spark.createDataFrame(rows, "ts int, user_id int, clue_id int, recommend_id string").repartition(3)
        got = sorted((str((r.ts, r.user_id, r.clue_id, r.recommend_id)), r.split) for r in O.time_split(df).collect())
        assert got == split_of(rows)


def test_cuts_of_few_rows_and_null_seconds(spark):
    schema = "ts int, user_id int, clue_id int, recommend_id string"
    for rows in ([], [(1, 1, 1, "r")], [(None, None, None, None)] * 4, [(k, 1, 1, "r") for k in range(9)]):
        got = O.time_split(spark.createDataFrame(rows, schema)).collect()
        assert sorted((str(tuple(r)[:4]), r.split) for r in got) == split_of(rows)


def jobs(spark, build):
    """How many jobs building a frame starts, beyond the map stages that runtime planning starts as jobs."""
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        before = scheduler.nextJobId().get() if hasattr(scheduler.nextJobId(), "get") else scheduler.nextJobId()
        build()
        after = scheduler.nextJobId().get() if hasattr(scheduler.nextJobId(), "get") else scheduler.nextJobId()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return after - before


def test_jobs_that_run_before_a_frame_exists(spark):
    from paddock.plans.preprocess import preprocess_fit

    rnd = random.Random(14)
    rows = spark.createDataFrame(
        [(i, rnd.randint(0, 9), i % 50, "r", i % 2, rnd.random(), f"{i % 7},{i % 5}", "2024-01-01") for i in range(300)],
        "ts int, user_id int, clue_id int, recommend_id string, label int, d_u_x double, "
        "d_seq_c2b_click_road_haul_seq string, dt string")
    assert jobs(spark, lambda: O.time_split(rows)) <= 4
    assert jobs(spark, lambda: M.auc(rows.withColumn("score", F.col("d_u_x")))) <= 1
    assert jobs(spark, lambda: Q.fit_medians(rows, ["d_u_x", "ts"])) <= 4
    assert jobs(spark, lambda: preprocess_fit(rows)) <= 6
