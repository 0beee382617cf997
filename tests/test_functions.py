import math

import pytest
from pyspark.sql import functions as F

from paddock import functions as X


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("score,code", [
    (None, -1), (-1, -1), (0, 35), (55, 35), (56, 65), (69, 65), (70, 80), (89, 80), (90, 95),
    (100, 95), (101, -1)])
def test_score_segment(spark, score, code):
    assert one(spark, score, "int", X.score_segment("x")) == code


@pytest.mark.parametrize("price,code", [
    (None, -1), (0, -1), (1, 2), (20000, 2), (20001, 4), (40001, 6), (60001, 9), (90001, 15),
    (150001, 1000), (10000000, 1000), (10000001, -1)])
def test_price_bin(spark, price, code):
    assert one(spark, price, "int", X.price_bin("x")) == code


@pytest.mark.parametrize("level,n", [("A", 1), ("D", 4), ("E", 0), (None, 0)])
def test_level_ordinal(spark, level, n):
    assert one(spark, level, "string", X.level_ordinal("x")) == n


@pytest.mark.parametrize("text,n", [("12", 12), ("", None), (None, None), ("unknown", None)])
def test_safe_int(spark, text, n):
    assert one(spark, text, "string", X.safe_int("x")) == n


def test_pad_array(spark):
    for value, want in (([5, None, 7], [5, None, 7, 1, 1]), ([], [1] * 5), (None, [1] * 5),
                        ([1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6])):
        assert one(spark, value, "array<int>", X.pad_array("x", 5, 1, "int")) == want
        assert one(spark, value, "array<int>", X.pad_array(F.col("x"), 5, F.lit(1), "int")) == want


def test_text_of_arrays_drops_nulls(spark):
    assert one(spark, [1, None, 3], "array<int>", X.join_array("x")) == "1,3"
    assert one(spark, None, "array<int>", X.join_array("x")) == ""
    assert one(spark, "1,3", "string", X.parse_array("x")) == [1.0, 3.0]
    assert one(spark, "", "string", X.parse_array("x")) is None


def test_medians(spark):
    assert one(spark, [1, 2, 3, 10], "array<int>", X.lower_median("x")) == 2
    assert one(spark, [10, None, 1, 3], "array<int>", X.lower_median("x")) == 3
    assert one(spark, [None], "array<int>", X.lower_median("x")) is None
    assert one(spark, [1, 2, 3, 10], "array<int>", X.array_median("x")) == 2.5
    assert one(spark, [], "array<int>", X.array_median("x")) is None
    assert one(spark, [1, None, 4], "array<int>", X.array_mean("x")) == 2.5
    assert one(spark, [None], "array<int>", X.array_mean("x")) is None


def test_pad_dense(spark):
    assert one(spark, [1.0, 5.0], "array<double>", X.pad_dense_local("x", 9.0, 4)) == [1, 5, 3, 3]
    assert one(spark, None, "array<double>", X.pad_dense_local("x", 9.0, 2)) == [9, 9]
    assert one(spark, [1.0], "array<double>", X.pad_dense_global("x", F.lit(9.0), 3)) == [1, 9, 9]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])],
                               "a array<double>, b array<double>, z array<double>")
    r = df.select(X.dot("a", "b").alias("d"), X.cosine("a", "b").alias("c"),
                  X.cosine("a", "z").alias("n"), X.vector_to_text("a").alias("t")).first()
    assert (r.d, round(r.c, 12), r.n, r.t) == (24.0, 0.96, None, "[3.0,4.0]")


def test_price_reached_needs_a_price(spark):
    df = spark.createDataFrame([(100, 100), (100, 0), (100, None), (81, 100)], "amount int, model_price int")
    rows = df.select(X.price_reached(0.8).alias("a"), X.price_reached(1.0).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 0), (0, 0), (1, 0)]


def test_draws_are_uniform_and_repeatable(spark):
    df = spark.range(20000).select(X.unit_draw(3, "id").alias("u"), X.unit_draw(3, "id").alias("v"))
    r = df.agg(F.avg("u").alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi"),
               F.sum(F.when(F.col("u") != F.col("v"), 1).otherwise(0)).alias("d")).first()
    assert abs(r.m - 0.5) < 0.01 and 0 < r.lo and r.hi <= 1 and r.d == 0


def test_year_and_sigmoid(spark):
    assert one(spark, "2015款 x", "string", X.year_from_title("x")) == "2015"
    assert one(spark, "x", "string", X.year_from_title("x")) == ""
    assert one(spark, 0.3, "double", X.sigmoid("x")) == pytest.approx(1 / (1 + math.exp(-0.3)))
