from collections import Counter

from pyspark.sql import functions as F

from paddock.operators import sampling as R
from paddock.operators.aggregates import favourite


def test_counts_and_numbers_match_the_join(spark):
    items = spark.createDataFrame(
        [("d", c, t) for c, t in ((1, 10), (2, 10), (66, 10), (3, 20), (4, 30))],
        "dt string, clue_id int, on_sale_ts int")
    queries = spark.createDataFrame(
        [("d", u, "r", "1", t) for u, t in ((1, 5), (2, 10), (3, 11), (4, 25), (5, 99))],
        "dt string, user_id int, recommend_id string, page string, query_ts int")
    counted, numbered = R.eligible_index(queries, items)
    assert {r.user_id: r.n for r in counted.collect()} == {1: 0, 2: 0, 3: 3, 4: 4, 5: 5}
    idx = {r.clue_id: r.idx for r in numbered.collect()}
    assert sorted(idx.values()) == [0, 1, 2, 3, 4] and idx[3] == 3 and idx[4] == 4


def test_negatives_are_on_sale_one_per_group_and_spread(spark):
    items = spark.range(20).select(F.lit("d").alias("dt"), F.col("id").cast("int").alias("clue_id"),
                                   (F.col("id") * 10).cast("int").alias("on_sale_ts"))
    queries = spark.range(2000).select(
        F.lit("d").alias("dt"), (F.col("id") % 3).cast("int").alias("user_id"),
        F.col("id").cast("string").alias("recommend_id"), F.lit("1").alias("page"),
        (F.col("id") % 200).cast("int").alias("query_ts"))
    out = R.sampled_negatives(queries, items, rate=1.0).collect()
    assert len(out) == 2000
    for r in out:
        assert r.clue_id is None if r.query_ts == 0 else r.clue_id * 10 < r.query_ts
    full = Counter(r.clue_id for r in out if r.query_ts > 190)
    assert len(full) > 12
    kept = R.sampled_negatives(queries, items, rate=0.3).count()
    assert 500 < kept < 700


def test_favourite_matches_join_back(spark):
    rows = [(1, "click", "tag", "a", 0.5), (1, "click", "tag", "b", 0.5), (1, "click", "tag", "z", 0.1),
            (2, "click", "tag", "a", 0.0), (3, "bid", "tag", "q", 1.0)]
    df = spark.createDataFrame(rows, "user_id int, action string, cluster string, key string, r double")
    out = favourite(df, "r", {"t": ("click", "tag"), "u": ("bid", "tag")})
    got = {r.user_id: (r.t, r.u) for r in out.collect()}
    assert got == {1: ("b", "-1"), 2: ("-1", "-1"), 3: ("-1", "q")}


def test_a_hot_second_is_numbered_in_parts(spark, monkeypatch):
    """All items of a day at once, and a usual day beside it: one order, whatever the parts."""
    monkeypatch.setattr(R, "PART_ROWS", 100)
    rows = [("d", c, 5000) for c in range(3000)] + [("e", c, 100 * (c % 7) + 7200 * (c % 3)) for c in range(300)]
    items = spark.createDataFrame(rows, "dt string, clue_id int, on_sale_ts int")
    queries = spark.createDataFrame([("d", 1, "r", "1", t) for t in (5000, 5001)] + [("e", 2, "r", "1", 7300)],
                                    "dt string, user_id int, recommend_id string, page string, query_ts int")
    counted, numbered = R.eligible_index(queries, items)
    assert {(r.dt, r.query_ts): r.n for r in counted.collect()} == {
        ("d", 5000): 0, ("d", 5001): 3000, ("e", 7300): sum(t < 7300 for d, _, t in rows if d == "e")}
    got = {(r.dt, r.clue_id): r.idx for r in numbered.collect()}
    for day in "de":
        own = items.where(F.col("dt") == day).select("clue_id", "on_sale_ts", R.hash32(R.ORDER_SEED, "clue_id").alias("h")).collect()
        order = sorted(own, key=lambda r: (r.on_sale_ts, r.h, r.clue_id))
        assert [got[day, r.clue_id] for r in order] == list(range(len(order)))
    # no task numbers more than a part
    seconds = R._seconds(queries, items, "dt").where("dt = 'd' and _cnt > 0").first()
    assert seconds["_cnt"] == 3000 and -(-seconds["_cnt"] // R.PART_ROWS) == 30


def test_no_items_or_no_requests(spark):
    items = spark.createDataFrame([("d", 1, 10)], "dt string, clue_id int, on_sale_ts int")
    queries = spark.createDataFrame([("d", 1, "r", "1", 11)], "dt string, user_id int, recommend_id string, page string, query_ts int")
    assert [r.n for r in R.eligible_index(queries, items.limit(0))[0].collect()] == [0]
    assert [r.idx for r in R.eligible_index(queries.limit(0), items)[1].collect()] == [0]
