import pytest

from paddock.operators import encoding as E
from paddock.operators import joins as J


def sample(spark):
    rows = [(1, i) for i in range(50)] + [(2, 50), (3, 51)] + [(None, i) for i in range(60, 70)]
    large = spark.createDataFrame(rows, "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z"), (None, "n")], "k int, name string")
    return large, lookup


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_the_plain_join(spark, how):
    large, lookup = sample(spark)
    got = sorted(map(str, J.lookup_join(large, lookup, "k", how).collect()))
    assert got == sorted(map(str, large.join(lookup, "k", how).collect()))


def test_one_hot_key_of_equal_rows_is_split_at_run_time(spark):
    """Grouped inputs on both sides, nine in ten rows alike: runtime skew handling still applies."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    large = spark.range(0, 60000, 1, 8).selectExpr(
        "if(id % 10 = 0, id, 7) as k", "repeat(uuid(), 3) as v")
    lookup = spark.range(0, 60000, 1, 8).selectExpr("id as k", "id % 5 as n").groupBy("k").max("n")
    before = {c: spark.conf.get(c, None) for c in held}
    for c, v in held.items():
        spark.conf.set(c, v)
    try:
        out = J.lookup_join(large, lookup, "k")
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_labels_default_to_zero(spark):
    seen = spark.createDataFrame([(1, "r", 5), (2, "r", 6)], "clue_id int, recommend_id string, ts int")
    flags = spark.createDataFrame([(1, "r", 1)], "clue_id int, recommend_id string, is_bid int")
    rows = sorted(map(tuple, J.attach_labels(seen, flags).select(
        "clue_id", "recommend_id", "ts", "is_bid").collect()))
    assert rows == [(1, "r", 5, 1), (2, "r", 6, 0)]


def codes(spark, extra=()):
    return spark.createDataFrame([("f", "x", 7), ("f", "y", 8), ("g", "new", 9), *extra],
                                 "fea_name string, fea_val string, encode_id int")


@pytest.mark.parametrize("key", ["id", None])
def test_encoding_with_and_without_a_key(spark, key):
    df = spark.createDataFrame([(1, "x"), (2, "new"), (3, None)], "id int, c string")
    out = E.encode_categories(df, {"c": "f"}, codes(spark), key=key)
    assert dict(map(tuple, out.select("id", "c").collect())) == {1: 7, 2: 1, 3: 1}
    arrays = spark.createDataFrame([(1, ["x", "new", None]), (2, []), (3, None)],
                                   "id int, c array<string>")
    out = E.encode_sequences(arrays, {"c": "f"}, codes(spark), key=key)
    got = dict(map(tuple, out.select("id", "c").collect()))
    assert got == {1: [7, 1, 1], 2: [], 3: None}


def test_encoding_of_null_keys_and_equal_rows(spark):
    df = spark.createDataFrame([(None, "x", ["x"]), (1, "y", ["y", "x"]), (1, "y", ["y", "x"])],
                               "id int, c string, a array<string>")
    out = E.encode_categories(df, {"c": "f"}, codes(spark))
    assert sorted(r.c for r in out.collect()) == [7, 8, 8]
    out = E.encode_sequences(df, {"a": "f"}, codes(spark))
    assert sorted(r.a for r in out.collect()) == [[7], [8, 7], [8, 7]]
    one = E.encode_categories(df.limit(1), {"c": "f"}, codes(spark), key="id")
    assert [r.c for r in one.collect()] == [7]


def test_a_repeated_value_has_its_smallest_id(spark):
    df = spark.createDataFrame([(1, "x")], "id int, c string")
    out = E.encode_categories(df, {"c": "f"}, codes(spark, [("f", "x", 3)]))
    assert [r.c for r in out.collect()] == [3]


def test_a_large_dictionary(spark):
    many = spark.range(25000).selectExpr("'f' as fea_name", "cast(id as string) as fea_val",
                                         "cast(id + 2 as int) as encode_id")
    df = spark.createDataFrame([(1, "24999"), (2, "x")], "id int, c string")
    out = E.encode_categories(df, {"c": "f"}, many)
    assert dict(map(tuple, out.collect())) == {1: 25001, 2: 1}


def test_rows_without_a_key_are_coded_once_per_combination(spark):
    """A third of the rows alike, nulls beside empty texts; nothing is written in between."""
    rows = [(i, "x" if i % 3 == 0 else [None, "", "null", "y"][i % 4], ["x", None][: i % 3] if i % 5 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, c string, a array<string>")
    out = E.encode_sequences(E.encode_categories(df, {"c": "f"}, codes(spark)), {"a": "f"}, codes(spark))
    assert out.columns == df.columns
    want = {i: ({"x": 7, "y": 8}.get(c, 1), None if a is None else [{"x": 7}.get(v, 1) for v in a]) for i, c, a in rows}
    assert {r.id: (r.c, r.a) for r in out.collect()} == want
    assert "cut" not in vars(E)
