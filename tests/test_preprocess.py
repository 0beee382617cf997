import pytest
from pyspark.sql import functions as F

from paddock import sources as S
from paddock.plans import preprocess as P

SCHEMA = ("user_id int, clue_id int, recommend_id string, label int, ts int, s_u_click_tag_id_0_7 int, "
          "d_u_cnt double, s_i_tag_id int, d_i_price double, d_i_flat double, "
          "s_seq_c2b_click_tag_id_seq string, d_seq_c2b_click_road_haul_seq string, dt string")


def table(spark):
    rows = [
        (8001 + i, i, f"r{i}", i % 2, i, None if i == 0 else i, None if i % 3 == 0 else float(i), 2,
         float(i * i), 4.0, "1,2" if i else "", ",".join(str(k) for k in range(i)), "2024-01-01")
        for i in range(9)]
    return spark.createDataFrame(rows, SCHEMA)


def test_fit_gives_mean_zero_and_deviation_one(spark):
    out, stats = P.preprocess_fit(table(spark), as_json=False)
    r = out.agg(*[f(c).alias(f"{n}_{c}") for c in ("d_u_cnt", "d_i_price")
                  for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    for c in ("d_u_cnt", "d_i_price"):
        assert r[f"m_{c}"] == pytest.approx(0, abs=1e-9) and r[f"s_{c}"] == pytest.approx(1)
    e = out.select(F.explode("d_seq_c2b_click_road_haul_seq").alias("x")).agg(
        F.count("*").alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert e.n == 90 and e.m == pytest.approx(0, abs=1e-9) and e.s == pytest.approx(1)
    flat = [x.d_i_flat for x in out.collect()]
    assert flat == [0.0] * 9  # no variance: scale 1
    first = out.where("original_user_id = 8001").first()
    assert first.user_id == 0 and first.s_u_click_tag_id_0_7 == 1


def test_apply_after_save_and_load_equals_fit(spark, tmp_path):
    out, stats = P.preprocess_fit(table(spark))
    S.save_stats(stats, str(tmp_path / "stats"))
    again = P.preprocess_apply(table(spark), S.load_stats(spark, str(tmp_path / "stats")))
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    one = S.load_stats(spark, str(tmp_path / "stats"), ["d_u_cnt"])
    assert [r.feature for r in one.collect()] == ["d_u_cnt"]


def test_attribute_names():
    assert P.attribute_of("s_u_click_tag_id_0_7") == "tag_id"
    assert P.attribute_of("s_i_c2b_evaluate_level") == "c2b_evaluate_level"
    assert P.attribute_of("s_seq_c2b_bid_car_year_seq") == "car_year"
    # columns that are no defined features: as their own name says
    assert P.attribute_of("s_i_paint") == "paint" and P.attribute_of("s_u_view_paint_kind_0_14") == "paint_kind"
    assert P.attribute_of("s_seq_c2b_view_paint_kind_seq") == "paint_kind" and P.attribute_of("city") == "city"


def test_categories_outside_the_definitions_are_coded(spark):
    rows = [(u, c, "r", 0, 5, paint, paint, None if paint is None else f"{paint},red", "2024-01-01")
            for u, c, paint in ((1, 1, "red"), (1, 1, "red"), (2, 1, "blue"), (3, 2, None), (4, 2, "odd"))]
    df = spark.createDataFrame(rows, "user_id int, clue_id int, recommend_id string, label int, ts int, s_i_paint string, "
                                     "s_u_view_paint_0_14 string, s_seq_c2b_view_paint_seq string, dt string")
    codes = spark.createDataFrame([("paint", "red", 2), ("paint", "blue", 3), ("other", "odd", 9)],
                                  "fea_name string, fea_val string, encode_id int")
    coded = P.encode_raw(df, codes)
    got = sorted((r.user_id, r.s_i_paint, r.s_u_view_paint_0_14, r.s_seq_c2b_view_paint_seq[:2]) for r in coded.collect())
    assert got == [(1, 2, 2, [2, 2]), (1, 2, 2, [2, 2]), (2, 3, 3, [3, 2]), (3, 1, 1, [1, 1]), (4, 1, 1, [1, 2])]
    out = P.preprocess_raw(df, codes)[0]
    assert sorted(r.s_i_paint for r in out.collect()) == [1, 1, 2, 2, 3]


def test_a_column_of_nulls_stays_null(spark):
    df = table(spark).withColumn("d_u_cnt", F.lit(None).cast("double"))
    out, _ = P.preprocess_fit(df, as_json=False)
    assert out.where("d_u_cnt is not null").count() == 0


def test_writers(spark, tmp_path):
    df = table(spark)
    path = str(tmp_path / "t")
    S.write_by_day(df.unionByName(df.withColumn("dt", F.lit("2024-01-02"))), path)
    S.write_by_day(df.limit(2), path)  # replaces one day and keeps the other
    got = spark.read.parquet(path).groupBy("dt").count().collect()
    assert {str(r.dt): r["count"] for r in got} == {"2024-01-01": 2, "2024-01-02": 9}
    S.write_csv(df, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert S.read_tsv(spark, str(tmp_path / "absent"), "a int").count() == 0
