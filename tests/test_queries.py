"""Queries against their SQL on the smallest tables."""

import os

import pytest

from checks import ORACLES, QUERIES
from checks.compare import check, connect

SF = "/root/testdata/sf0.001"
SOME = ["entry_last_clicked_items", "p1_train_samples", "p2_impression_labels",
        "p4_user_offline_features", "p5_item_features", "p7_sample_sequences", "p9_preprocess_fit",
        "p12_refresh_user_vectors", "p14_evaluate", "m2_gauc", "m6_recall_at_n", "t3_time_split"]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, con, name):
    text, _, _ = check(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert text.startswith("ok"), text


def test_a_range_of_days_is_labelled_as_its_days(spark):
    from functools import reduce

    from checks.fixtures import Tables
    from paddock.plans.samples import impression_labels

    t = Tables(spark, SF)
    days = [r.dt for r in t.behaviour.select("dt").distinct().collect()]
    whole = impression_labels(t.behaviour, t.day_prices, t.orders)
    parts = [impression_labels(t.behaviour.where(t.behaviour.dt == d), t.day_prices, t.orders) for d in days[:4]]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    got, want = rows.collect(), whole.where(whole.dt.isin(days[:4])).collect()
    assert got and sorted(map(str, got)) == sorted(map(str, want))


def test_scenes_select_their_own_samples(spark):
    from checks.fixtures import Tables
    from paddock.plans.samples import train_samples

    t = Tables(spark, SF)
    search, grab = (train_samples(t.behaviour, scene=s).collect() for s in ("SEARCH", "GRAB"))
    assert search and grab and not {(r.user_id, r.ts) for r in search} & {(r.user_id, r.ts) for r in grab}


def test_a_range_of_days_has_the_rows_of_each_daily_job(spark):
    from checks.fixtures import Tables
    from paddock.plans.daily import daily_samples, range_samples

    t = Tables(spark, SF)
    days = ["2024-01-12", "2024-01-13"]
    whole = range_samples(t.inputs, *days)
    got = whole.collect()
    for day in days:
        own = daily_samples(t.inputs, day).select(*whole.columns).collect()
        assert own and sorted(map(str, own)) == sorted(str(r) for r in got if r.dt == day)
    assert {r.dt for r in got} == set(days)


def test_days_without_a_range_function_are_put_together(spark):
    from paddock.plans.daily import Inputs

    def frame(day):
        return spark.createDataFrame([(1, day)], "user_id int, made string")

    inputs = Inputs(None, None, None, None, items=None, rates=lambda day: (frame(day), frame(day)), users=frame, min_create="")
    rows = inputs.between("users", "2024-01-30", "2024-02-02").collect()
    assert [(r.made, r.dt) for r in rows] == [(d, d) for d in ("2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02")]
    assert [f.count() for f in inputs.between("rates", "2024-01-30", "2024-01-31")] == [2, 2]


def test_a_backfill_replaces_its_days_and_no_others(spark, monkeypatch, tmp_path):
    from paddock.plans import daily

    asked = []

    def rows(inputs, start, end, scene, **kw):
        asked.append((start, end))
        return spark.createDataFrame([(d, len(asked)) for d in daily.days_between(start, end)], "dt string, run int")

    monkeypatch.setattr(daily, "range_samples", rows)
    path = str(tmp_path / "samples")
    daily.backfill(None, "2024-01-01", "2024-01-05", path, together=2)
    daily.backfill(None, "2024-01-04", "2024-01-04", path)
    assert asked == [("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-04"), ("2024-01-05", "2024-01-05"),
                     ("2024-01-04", "2024-01-04")]
    back = {str(r.dt): (r.run, r.scene) for r in spark.read.parquet(path).collect()}
    assert back == {f"2024-01-0{d}": (n, "SEARCH") for d, n in zip(range(1, 6), (1, 1, 2, 4, 3))}


def test_every_query_of_the_inventory_is_registered():
    ids = {n.split("_")[0] for n in QUERIES}
    for letter, last in {"s": 13, "f": 14, "j": 14, "a": 17, "w": 5, "t": 3, "u": 2, "c": 24,
                         "m": 10, "p": 15}.items():
        missing = {f"{letter}{i}" for i in range(1, last + 1)} - ids
        assert missing <= {"j8", "c8"}  # both are part of a7
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["user_id", "ts", "clue_id", "tag_id"] and df.count() > 0


@pytest.fixture(scope="module")
def ties(spark, tmp_path_factory):
    """Vectors of floats whose text is a tie of the last digit compared, or a whole thousandth."""
    folder = tmp_path_factory.mktemp("ties")
    values = [k / 20000 for k in range(1, 400, 2)] + [k / 1000 for k in range(1, 200)]
    rows = [(k, values[k:k + 20], k // 7) for k in range(len(values) - 20)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(
        str(folder / "embeddings.parquet"))
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", [
    "c23_vector_text", "f10_array_columns", "s10_arrays_json", "s12_kv_payload", "s13_upsert_payload"])
def test_vectors_of_floats_are_read_and_multiplied_as_floats(spark, ties, name):
    text, _, _ = check(spark, ties[1], ties[0], name, QUERIES[name], ORACLES[name])
    assert text.startswith("ok"), text
