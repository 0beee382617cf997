"""What the plans of the jobs must and must not contain."""

import pytest

from checks.fixtures import RUN, Tables
from paddock import sources as S
from paddock.operators import windows as W
from paddock.plans.daily import daily_samples
from paddock.plans.samples import impression_labels, train_samples

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def test_day_scans_prune_partitions_and_columns(spark, t, tmp_path):
    path = str(tmp_path / "behaviour")
    S.write_by_day(t.behaviour, path)
    table = spark.read.parquet(path)
    text = plan(S.scan_window(table, RUN, -3, 0).where("action = 'click'").select("clue_id"))
    assert "PartitionFilters: [isnotnull(dt" in text.replace("isnotnull(cast(dt", "isnotnull(dt")
    assert "PushedFilters: [IsNotNull(action), EqualTo(action,click)]" in text
    assert "ReadSchema: struct<clue_id:string,action:string>" in text


def test_ranking_is_limited_before_the_shuffle(t):
    text = plan(W.last_k_history(t.clicks))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("job", ["train", "labels", "daily"])
def test_no_nested_loops(t, job):
    df = {
        "train": lambda: train_samples(t.behaviour),
        "labels": lambda: impression_labels(t.behaviour, t.day_prices, t.orders),
        "daily": lambda: daily_samples(t.inputs, RUN),
    }[job]()
    text = plan(df)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_user_favourites_share_one_partitioning(spark, t):
    """The star of user features joins what is already grouped by user."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(t.user_features("2024-01-26"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the dictionary is not broadcast here, so coded favourites come back to their user once more
    assert text.count("hashpartitioning(user_id#") <= 10


SF = "/root/testdata/sf0.001"


def scans(df):
    """The file scans of a plan, with their partition filters."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line]


@pytest.mark.parametrize("name", ["s1_scan_day", "s2_scan_window", "s3_scan_snapshot", "s5_scan_days"])
def test_registered_scans_read_their_days_only(spark, name):
    from checks import QUERIES

    found = scans(QUERIES[name](spark, SF))
    assert found and all("PartitionFilters: [" in x and "dt#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in found)


def test_listed_days_prune_while_the_query_runs(spark):
    from checks import QUERIES

    found = scans(QUERIES["s5_scan_listed_days"](spark, SF))
    assert any("dynamicpruning" in x for x in found)


def test_no_join_is_broadcast_by_an_estimate(spark, tmp_path):
    """A small file exploded to all days is a large table that estimates take for small."""
    from paddock.session import tune

    tune(spark)
    path = str(tmp_path / "items")
    spark.range(50).selectExpr("cast(id as int) as clue_id", "repeat('x', 50) as title").write.parquet(path)
    days = spark.read.parquet(path).selectExpr("*", "explode(sequence(1, 1000)) as day")
    asked = spark.range(100_000).selectExpr("cast(id % 50 as int) as clue_id", "cast(id % 1000 as int) as day")
    plan = asked.join(days, ["clue_id", "day"])._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_items_nobody_asks_for_drop_out_before_the_days(spark):
    from types import SimpleNamespace

    from paddock.plans.daily import _snapshots_on

    items = spark.range(1000).selectExpr("cast(id as int) as clue_id", "id % 7 as seats")
    days = items.selectExpr("*", "explode(array('2024-01-01', '2024-01-02', '2024-01-03')) as dt")
    asked = spark.createDataFrame([("2024-01-02", 5), ("2024-01-03", 9), ("2024-01-04", 9)], "dt string, clue_id int")
    got = _snapshots_on(SimpleNamespace(between=lambda kind, start, end: days), asked, "2024-01-01", "2024-01-04")
    assert sorted(map(tuple, got.select("dt", "clue_id", "seats").collect())) == [("2024-01-02", 5, 5), ("2024-01-03", 9, 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("LeftSemi")  # the join to the asked items lies below the explode


def test_prices_by_day_read_the_days_looked_back_on_only(spark):
    from paddock.plans.items import prices_by_day

    log = spark.createDataFrame(
        [("1", d, 1, "5", "4", "3") for d in ("2020-01-01", "2023-12-31", "2024-01-01", "2024-01-09", "2024-02-01")],
        "clue_id string, dt string, ts int, model_price string, seller_price string, car_level string")
    asked = spark.createDataFrame([("2024-01-10", 1), ("2024-01-12", 1), ("2024-01-12", 2)], "dt string, clue_id int")
    out = prices_by_day(asked, log, days=9)
    assert sorted((r.dt, r.clue_id, r.model_price) for r in out.collect()) == [
        ("2024-01-10", 1, 5), ("2024-01-12", 1, 5), ("2024-01-12", 2, None)]
    read = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "dt" in line and "Filter" in line]
    assert any("scalar-subquery" in line and ">=" in line and "<=" in line for line in read), read
    assert prices_by_day(asked.limit(0), log, days=9).count() == 0


def test_users_of_many_days_are_shuffled_before_their_rows_are_multiplied(spark, t):
    """Rows of counts become one per day and one per category inside the tasks that group them."""
    from paddock.plans import names as N
    from paddock.plans.users import encoded_favourites

    def above(text, mark):
        lines = text.splitlines()
        return "\n".join(lines[:next(i for i, x in enumerate(lines) if "Generate" in x and mark in x)])

    assert "hashpartitioning" not in above(plan(t._counts("2024-01-20", "2024-01-26")), "sequence(")
    rows = [(d, u, a, u % 3 + k, 1, 2, 3) for d in ("2024-01-20", "2024-01-21") for u in range(5)
            for a in ("click", "bid") for k in range(4)]
    counts = spark.createDataFrame(
        rows, "dt string, user_id int, action string, clue_id int, cnt_0_7 long, cnt_7_14 long, cnt_14_30 long")
    by = ("dt", "user_id", "action", "cluster")
    asked = (by, "ratio_0_7", N.action_favourites(), t.codes, ("dt", "user_id"))
    ratios = t._action_ratio(counts)
    got = encoded_favourites(ratios, *asked, placed=True)
    assert "hashpartitioning" not in above(plan(got), "cluster, tag_id")
    want = sorted(map(str, encoded_favourites(ratios, *asked).collect()))
    assert len(want) == 10 and sorted(map(str, got.collect())) == want


def test_favourites_of_two_ratios_are_those_of_each(spark, monkeypatch):
    from paddock.operators import encoding
    from paddock.operators.aggregates import favourite_long, favourites_long

    rows = [(1, "c", "a", 0.5, 0.0), (1, "c", "b", 0.5, 0.0), (1, "d", "a", 0.1, 0.9), (1, "d", "b", 0.2, 0.3), (2, "c", None, 0.4, 1.0)]
    df = spark.createDataFrame(rows, "user_id int, cluster string, key string, x double, y double")
    both = favourites_long(df, ["user_id", "cluster"], ["x", "y"])
    for r in ("x", "y"):
        want = favourite_long(df, ["user_id", "cluster"], r).collect()
        got = both.where(both.ratio == r).select("user_id", "cluster", "best_key").collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    # the same codes from a dictionary that is sent to the rows and from one that is not
    codes = spark.createDataFrame([("c", "b", 7), ("d", "a", 8), ("d", "a", 6), ("d", None, 5)],
                                  "fea_name string, fea_val string, encode_id int")
    found = []
    for most in (encoding.SENT_BYTES, 0):
        monkeypatch.setattr(encoding, "SENT_BYTES", most)
        out = encoding.encode_long(both, both.cluster, both.best_key, codes)
        assert ("Broadcast" in plan(out)) == (most > 0)
        found.append(sorted(map(str, out.collect())))
    assert found[0] == found[1] and sorted(r.encode_id for r in out.collect()) == [1, 1, 1, 1, 6, 7]
