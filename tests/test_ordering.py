import random
import statistics

import pytest
from pyspark.sql import functions as F

from paddock.operators import ordering as O
from paddock.operators import quantiles as Q


def test_running_total_by_group(spark):
    rnd = random.Random(1)
    rows = {(rnd.choice("aab"), rnd.randint(0, 500)): rnd.randint(1, 5) for _ in range(400)}
    df = spark.createDataFrame([(g, v, w) for (g, v), w in rows.items()], "g string, v int, w int")
    got = {(r.g, r.v): r.cum_w for r in O.running_total(df, ["v"], ["w"], by=["g"]).collect()}
    for g in "ab":
        total = 0
        for key in sorted(k for k in rows if k[0] == g):
            total += rows[key]
            assert got[key] == total


@pytest.mark.parametrize("p", [0.5, 0.03, 0.97])
def test_exact_quantile(spark, p):
    rnd = random.Random(2)
    data = {"a": [rnd.randint(0, 20) * 1.0 for _ in range(101)], "b": [rnd.random() for _ in range(64)]}
    rows = [(f, v) for f, vs in data.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "feature string, value double")
    got = {r.feature: r.value for r in Q.exact_quantiles(df, [p]).collect()}
    for f, vs in data.items():
        vs = sorted(vs)
        at = p * (len(vs) - 1)
        lo = int(at)
        hi = min(lo + 1, len(vs) - 1)
        assert got[f] == pytest.approx(vs[lo] + (at - lo) * (vs[hi] - vs[lo]))


def test_medians_of_columns_and_sequences(spark):
    df = spark.createDataFrame(
        [(1.0, [1.0, 9.0]), (None, None), (4.0, [3.0])], "x double, s array<double>")
    got = {r.feature: r["median"] for r in Q.fit_medians(df, ["x"], ["s"]).collect()}
    assert got == {"x": 2.5, "s": statistics.median([1, 9, 3])}


def test_global_index_is_a_permutation_in_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    rows = sorted(O.global_index(df, ["k"]).collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(1000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_time_split_is_a_partition_in_time(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), i, 0, "r") for i in range(333)]
    df = spark.createDataFrame(rows, "ts int, user_id int, clue_id int, recommend_id string")
    out = O.time_split(df).collect()
    order = sorted(out, key=lambda r: (r.ts, r.user_id))
    n = len(rows)
    assert [r.split for r in order] == (
        ["train"] * int(n * 0.8) + ["valid"] * (int(n * 0.9) - int(n * 0.8))
        + ["test"] * (n - int(n * 0.9)))


def test_time_split_shares_out_copies(spark):
    rows = [(5, 1, 1, "r")] * 97 + [(9, 1, 1, "r")] * 3
    df = spark.createDataFrame(rows, "ts int, user_id int, clue_id int, recommend_id string")
    got = {r.split: r.n for r in O.time_split(df).groupBy("split").agg(
        F.count("*").alias("n")).collect()}
    assert got == {"train": 80, "valid": 10, "test": 10}


def test_trimmed_scaler(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e9,)], "x double")
    r = Q.fit_trimmed_scaler(df, ["x"]).first()
    kept = [float(i) for i in range(3, 98)]
    assert r["mean"] == pytest.approx(statistics.mean(kept))
    assert r["scale"] == pytest.approx(statistics.pstdev(kept))


def test_time_split_with_null_ties(spark):
    rows = [(100, None if i < 4 else i, 1, "r") for i in range(10)]
    df = spark.createDataFrame(rows, "ts int, clue_id int, user_id int, recommend_id string")
    got = [r.split for r in O.time_split(df, ties=("clue_id", "user_id", "recommend_id")).collect()]
    assert (got.count("train"), got.count("valid"), got.count("test")) == (8, 1, 1)
