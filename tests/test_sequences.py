import random

from pyspark.sql import functions as F

from paddock.operators import sequences as Q


def brute(spine, events, k=10, lag=60):
    out = {}
    for u, ts in set(spine):
        seen = [(e, c) for v, e, c in events if v == u and ts > e + lag]
        out[(u, ts)] = sorted(seen, reverse=True)[:k]
    return out


def frames(spark, spine, events):
    return (spark.createDataFrame(spine, "user_id int, ts int"),
            spark.createDataFrame(events, "user_id int, ts int, clue_id int"))


def got(df):
    return {(r.user_id, r.ts): [(e.ts, e.clue_id) for e in r.hist] for r in df.collect()}


def test_visibility_is_strict(spark):
    spine, events = frames(spark, [(1, 1000)], [(1, 939, 5), (1, 940, 6), (1, 941, 7)])
    assert got(Q.last_k_before(spine, events)) == {(1, 1000): [(939, 5)]}


def test_matches_brute_force_with_ties_hot_user_and_small_buckets(spark):
    rnd = random.Random(5)
    user = lambda: 1 if rnd.random() < 0.4 else rnd.randint(2, 9)
    events = [(user(), rnd.randint(0, 6000), rnd.randint(0, 4)) for _ in range(900)]
    spine = [(user(), rnd.randint(0, 7000)) for _ in range(300)] + [(99, 5000)]
    s, e = frames(spark, spine, events)
    want = brute(spine, events)
    for bucket in (50, 1000, 100000):
        assert got(Q.last_k_before(s, e, bucket=bucket)) == want


def test_more_than_k_events_in_one_second(spark):
    s, e = frames(spark, [(1, 500), (1, 501)], [(1, 400, c) for c in range(30)])
    want = [(400, c) for c in range(29, 19, -1)]
    assert got(Q.last_k_before(s, e)) == {(1, 500): want, (1, 501): want}


def test_floor_limits_the_lookback(spark):
    s, e = frames(spark, [(1, 5000)], [(1, 100, 1), (1, 3000, 2)])
    s = s.withColumn("since", F.col("ts") - 2500)
    assert got(Q.last_k_before(s, e, floor="since")) == {(1, 5000): [(3000, 2)]}


def test_unknown_items_drop_and_arrays_keep_nulls(spark):
    s, e = frames(spark, [(1, 1000)], [(1, 10, 1), (1, 20, 2), (1, 30, 3)])
    items = spark.createDataFrame([(1, 7), (3, None)], "clue_id int, price int")
    r = Q.last_items(s, e, items, ["clue_id", "price"]).first()
    assert (r.clue_id, r.price) == ([3, 1], [None, 7])
    padded = Q.last_items(s, e, items, ["clue_id"], k=4, pad="1").first()
    assert padded.clue_id == ["3", "1", "1", "1"]


def test_recent_stats(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 10]), (2, [None, 4])], "u int, x array<int>")
    rows = Q.recent_stats(df, {"x": "x_{stat}"}, keep=["u"]).orderBy("u").collect()
    assert [tuple(r) for r in rows] == [(1, 4.0, 10, 1, 2), (2, 4.0, 4, 4, 4)]


def test_a_column_says_when_events_are_seen(spark):
    rnd = random.Random(9)
    events = sorted((1 if rnd.random() < .6 else 2, rnd.randint(0, 4000), rnd.randint(0, 4)) for _ in range(400))
    spine = [(rnd.randint(1, 2), rnd.randint(0, 5000)) for _ in range(150)]
    late = lambda ts: max(ts + 60, (ts // 1000 + 1) * 1000 - 1)
    s, e = frames(spark, spine, events)
    e = e.withColumn("seen", F.greatest(F.col("ts") + 60, (F.floor(F.col("ts") / 1000) + 1) * 1000 - 1))
    want = {(u, ts): sorted([(x, c) for v, x, c in events if v == u and ts > late(x)], reverse=True)[:10] for u, ts in set(spine)}
    for bucket in (70, 900, 100000):
        assert got(Q.last_k_before(s, e, seen="seen", bucket=bucket)) == want


def test_moments_of_many_days_look_back_from_their_own_day(spark):
    """More than ten clicks before and after a sample, days that have gone out of sight, orders of the day itself."""
    from paddock.plans.histories import events_between, history_rows

    day, base = 86400, 1704067200  # 2024-01-01
    rnd = random.Random(3)
    acts = [(u, rnd.choice(["click", "bid", "order"]), base + rnd.randint(0, 60 * day), rnd.randint(1, 50))
            for u in (1, 1, 1, 2) for _ in range(120)]
    acts += [(1, a, base + 40 * day - x, 7) for a in ("click", "order") for x in (1, 30, 59, 60, 61, 62)]
    moments = [(rnd.choice([1, 1, 2]), base + rnd.randint(30 * day, 59 * day)) for _ in range(60)]
    moments += [(1, base + 40 * day + x) for x in (0, 1, 29, 30, 31, 59, 60)]
    iso = lambda ts: F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd")
    rows = spark.createDataFrame(acts, "user_id int, action string, ts long, clue_id int")
    log = rows.where("action <> 'order'").select(*[F.col(c).cast("string").alias(c) for c in ("user_id", "action", "ts", "clue_id")],
                                                 iso("ts").alias("dt"))
    orders = rows.where("action = 'order'").select(
        "user_id", "clue_id", F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    spine = spark.createDataFrame(moments, "user_id int, ts int")
    events = events_between(log, orders, "2024-01-31", "2024-02-28")
    have = {}
    for r in history_rows(spine, events).collect():
        have.setdefault((r.user_id, r.ts, r.action), []).append((r.rn, r.clue_id))
    for u, ts in set(moments):
        today = (ts - base) // day
        for action, name, back, until in (("click", "click", 29, 0), ("bid", "bid", 29, 0), ("order", "contract", 90, 1)):
            seen = [(x, c) for v, a, x, c in acts if v == u and a == action and ts > x + 60
                    and today - back <= (x - base) // day <= today - until]
            want = [(n + 1, c) for n, (_, c) in enumerate(sorted(seen, reverse=True)[:10])]
            assert sorted(have.get((u, ts, name), [])) == want, (u, ts, action)
