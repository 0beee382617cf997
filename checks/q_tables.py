"""Sources, sinks, filters and column guards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.fixtures import RUN, SNAP
from checks.registry import digits, digits_sql, query
from paddock import sources as S
from paddock.functions import safe_int
from paddock.operators import filters as P
from paddock.plans import names as N
from paddock.plans.preprocess import fit, prepare
from paddock.plans.refresh import read_vectors, write_vectors
from paddock.session import shared_dir


def scratch(t, name):
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("s1_scan_day", f"""
SELECT user_id, clue_id, ts, amount FROM behaviour WHERE dt = '{RUN}' AND action = 'click'""")
def _(t):
    return S.scan_day(t.behaviour, RUN, action="click").select("user_id", "clue_id", "ts", "amount")


@query("s2_scan_window", """
SELECT dt, action, count(*) AS n FROM behaviour
WHERE dt BETWEEN '2023-12-29' AND '2024-01-26' GROUP BY ALL""")
def _(t):
    return S.scan_window(t.behaviour, RUN, -29, -1).groupBy("dt", "action").agg(
        F.count("*").alias("n"))


@query("s3_scan_snapshot", f"""
SELECT user_id, clue_id, recommend_id, page, page_type, action, amount, ts FROM behaviour
WHERE dt = '{SNAP}'""")
def _(t):
    return S.scan_snapshot(t.behaviour, RUN)


@query("s4_scan_dictionary", "SELECT fea_name, fea_val, encode_id FROM codes")
def _(t):
    return S.scan_dictionary(t.dictionary, N.DICTIONARY_VERSION)


@query("s5_scan_days", """
SELECT dt, count(*) AS n FROM behaviour
WHERE dt BETWEEN '2024-01-01' AND '2024-02-15' AND dt <> '2024-01-13' GROUP BY dt""")
def _(t):
    days = S.scan_days(t.behaviour, "2024-01-01", "2024-02-15", ("2024-01-13",))
    return days.groupBy("dt").agg(F.count("*").alias("n"))


@query("s5_scan_listed_days", """
SELECT dt, action, count(*) AS n FROM behaviour WHERE dt IN (SELECT dt FROM (
  SELECT dt, count(*) AS bids FROM behaviour WHERE action = 'bid' GROUP BY dt) b
  WHERE bids > (SELECT avg(bids) FROM (SELECT count(*) AS bids FROM behaviour WHERE action = 'bid' GROUP BY dt) a))
GROUP BY ALL""")
def _(t):
    """The days with more bids than an average one: which partitions are read is known at run time."""
    bids = S.count_by_day(t.behaviour.where("action = 'bid'"), "bids")
    days = bids.where(F.col("bids") > bids.agg(F.avg("bids")).scalar())
    return S.scan_listed_days(t.behaviour, days).groupBy("dt", "action").agg(F.count("*").alias("n"))


@query("s6_read_tsv", f"""
SELECT cast(vec_id AS INT) AS vec_id, cast(len(embedding) AS INT) AS n,
  {digits_sql('embedding')} AS cells FROM embeddings""")
def _(t):
    path = scratch(t, "vectors")
    write_vectors(t.vectors, path, key="vec_id")
    back = read_vectors(t.spark, path, key="vec_id")
    return back.select("vec_id", F.size("embedding").alias("n"), digits("embedding").alias("cells"))


@query("s7_write_partition", """
SELECT user_id, clue_id, recommend_id, page, page_type, action, amount, ts, dt FROM behaviour
WHERE action IN ('click', 'bid')""")
def _(t):
    path = scratch(t, "partitions")
    for action in ("click", "bid", "click"):  # the second click run replaces the first
        rows = P.filter_actions(t.behaviour, [action]).drop("action")
        S.write_partition(rows, path, action=action)
    return t.spark.read.schema(t.behaviour.schema).parquet(path)


@query("s8_write_csv", "SELECT user_id, clue_id, recommend_id, label, ts FROM samples")
def _(t):
    path = scratch(t, "csv")
    S.write_csv(t.samples.drop("dt"), path)
    return t.spark.read.csv(
        path, header=True,
        schema="user_id int, clue_id int, recommend_id string, label int, ts int")


@query("s9_write_by_day", "SELECT dt, user_id, clue_id, recommend_id, label, ts FROM samples")
def _(t):
    path = scratch(t, "days")
    S.write_by_day(t.samples, path)
    return t.spark.read.schema(t.samples.schema).parquet(path)


@query("s10_arrays_json", f"""
SELECT vec_id, cast(len(embedding) AS INT) AS n, {digits_sql('embedding')} AS cells,
  '[' AS opening FROM embeddings""")
def _(t):
    text = S.encode_arrays_json(t.vectors, ["embedding"])
    back = S.decode_arrays_json(
        text.withColumn("opening", F.substring("embedding", 1, 1)), ["embedding"], "float")
    return back.select("vec_id", F.size("embedding").alias("n"), digits("embedding").alias("cells"), "opening")


@query("s11_save_load_stats", """
WITH m AS (SELECT median(d_i_road_haul) AS a, median(d_i_c2b_evaluate_score) AS b FROM features)
SELECT 'd_i_road_haul' AS feature, 'dense' AS kind, round(a, 6)::DOUBLE AS median,
  round((SELECT avg(coalesce(d_i_road_haul, a)) FROM features), 6) AS mean,
  round((SELECT stddev_pop(coalesce(d_i_road_haul, a)) FROM features), 6) AS scale FROM m
UNION ALL SELECT 'd_i_c2b_evaluate_score', 'dense', round(b, 6)::DOUBLE,
  round((SELECT avg(coalesce(d_i_c2b_evaluate_score, b)) FROM features), 6),
  round((SELECT stddev_pop(coalesce(d_i_c2b_evaluate_score, b)) FROM features), 6) FROM m""")
def _(t):
    families = P.feature_families(t.features)
    path = scratch(t, "stats")
    S.save_stats(fit(prepare(t.features, families), families), path)
    got = S.load_stats(t.spark, path, ["d_i_road_haul", "d_i_c2b_evaluate_score"])
    return got.select("feature", "kind", *[
        F.round(c, 6).alias(c) for c in ("median", "mean", "scale")])


@query("s12_kv_payload", f"""
SELECT concat('vector:', vec_id) AS key, 604800 AS ttl, cast(len(embedding) AS INT) AS n,
  {digits_sql('embedding')} AS cells FROM embeddings""")
def _(t):
    out = S.kv_payload(t.vectors, "vector:%s", key="vec_id")
    v = F.from_json("value", "array<float>")
    return out.select("key", "ttl", F.size(v).alias("n"), digits(v).alias("cells"))


@query("s13_upsert_payload", f"""
SELECT clue_id, 'v2' AS model_version, cast(len(embedding) AS INT) AS n, {digits_sql('embedding')} AS cells
FROM (SELECT label AS clue_id, embedding, row_number() OVER (PARTITION BY label
      ORDER BY vec_id DESC) AS rn FROM embeddings) e WHERE rn = 1""")
def _(t):
    """The label plays the item written many times; the latest vector stays."""
    rows = t.vectors.withColumnRenamed("label", "clue_id")
    stored = S.upsert_payload(rows, "v1", order="vec_id")
    changes = S.upsert_payload(rows, "v2", order="vec_id")
    out = S.merge_upsert(stored, changes)
    v = F.from_json("embedding", "array<float>")
    return out.select("clue_id", "model_version", F.size(v).alias("n"), digits(v).alias("cells"))


@query("f1_filter_scene", """
SELECT user_id, clue_id, page_type, ts FROM behaviour
WHERE page_type LIKE '%SEARCH%' AND NOT page_type LIKE '%INVITATION%'""")
def _(t):
    return P.filter_scene(t.behaviour).select("user_id", "clue_id", "page_type", "ts")


@query("f2_filter_scene_any", """
SELECT page_type, count(*) AS n FROM behaviour
WHERE page_type LIKE '%SEARCH%' OR page_type LIKE '%GRAB%' GROUP BY page_type""")
def _(t):
    return P.filter_scene_any(t.behaviour).groupBy("page_type").agg(F.count("*").alias("n"))


@query("f3_valid_ids", """
SELECT user_id, clue_id, ts FROM behaviour WHERE user_id IS NOT NULL AND user_id <> ''
  AND user_id > '0' AND clue_id IS NOT NULL AND clue_id <> '' AND clue_id > '0'""")
def _(t):
    return P.valid_ids(t.behaviour).select("user_id", "clue_id", "ts")


@query("f4_filter_actions", """
SELECT action, count(*) AS n FROM behaviour
WHERE action IN ('beseen', 'click', 'quick_collection', 'bid') GROUP BY action""")
def _(t):
    rows = P.filter_actions(t.behaviour, ["beseen", "click", "quick_collection", "bid"])
    return rows.groupBy("action").agg(F.count("*").alias("n"))


@query("f5_safe_int", """
SELECT recommend_id, try_cast(clue_id AS INT) AS clue_id,
  try_cast(split_part(recommend_id, '-', 2) AS INT) AS week,
  CASE WHEN page_type LIKE '%x' THEN 0 END AS bad FROM behaviour""")
def _(t):
    """Page types are not numbers: they become null and do not fail the job."""
    rows = t.behaviour.withColumn("week", F.split("recommend_id", "-")[1])
    return rows.select("recommend_id", safe_int("clue_id").alias("clue_id"),
                       safe_int("week").alias("week"), safe_int("page_type").alias("bad"))


@query("f6_on_sale", "SELECT clue_id, auction_type FROM items WHERE sale_status = 0 AND auction_type IN (1, 2)")
def _(t):
    return P.on_sale(t.items).select("clue_id", "auction_type")


@query("f7_only_keys", """
SELECT clue_id, tag_id FROM items WHERE clue_id IN (SELECT cast(clue_id AS INT) FROM behaviour)""")
def _(t):
    keys = P.int_ids(t.behaviour, ["clue_id"])
    return P.only_keys(t.items, "clue_id", keys).select("clue_id", "tag_id")


@query("f8_recent_items", "SELECT clue_id, create_time FROM items WHERE create_time > '2024'")
def _(t):
    return P.recent_items(t.items, "2024").select("clue_id", "create_time")


@query("f9_feature_families", """
SELECT s_u_click_tag_id_0_7, user_id, d_u_click_cnt_0_7, d_u_click_road_haul_max_0_7,
  array_to_string(tags, ',') AS s_seq_c2b_click_tag_id_seq,
  coalesce(array_to_string(hauls, ','), '') AS d_seq_c2b_click_road_haul_seq,
  coalesce(array_to_string(sellers, ','), '') AS d_seq_c2b_click_c2b_seller_price_seq,
  s_i_tag_id, s_i_city_id, d_i_c2b_evaluate_score, d_i_c2b_ctob_model_price, d_i_road_haul
FROM features""")
def _(t):
    """The feature table in the model's column order."""
    return t.features.select(*P.model_order(P.feature_families(t.features)))


@query("f10_array_columns", """
SELECT vec_id, array_to_string(list_transform(embedding, lambda x: cast(floor(x * 1000) AS INT)), ',')
  AS embedding, label FROM embeddings""")
def _(t):
    """Every array column, found by type, as comma text."""
    # the product is one of floats
    whole = F.transform("embedding", lambda x: F.floor(x * F.lit(1000).cast("float")).cast("int"))
    rows = t.vectors.withColumn("embedding", whole)
    arrays = set(P.array_columns(rows))
    return rows.select(*[
        F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) if c in arrays else F.col(c)
        for c in rows.columns])


@query("f11_default_if_null", """
SELECT clue_id, coalesce(evaluate_score, 0) AS evaluate_score, coalesce(model_price, 0) AS model_price,
  seats FROM priced_run""")
def _(t):
    rows = t.priced(RUN).select("clue_id", "evaluate_score", "model_price", "seats")
    return P.fill_defaults(rows, ["evaluate_score", "model_price"], 0)


@query("f12_namespaced", """
SELECT clue_id, model_price AS d_i_model_price_now, seller_price AS d_i_seller_price_now,
  car_level AS d_i_car_level_now FROM prices_run""")
def _(t):
    return P.namespaced(t.prices(RUN), "d_i_", "_now", keep=["clue_id"])


@query("f13_blank_to_null", """
SELECT user_id, ts, nullif(array_to_string(sellers, ','), '') AS sellers FROM features""")
def _(t):
    rows = P.blank_to_null(t.features)
    return rows.select("user_id", "ts", F.col("d_seq_c2b_click_c2b_seller_price_seq").alias("sellers"))


@query("f14_cast_families", """
SELECT user_id, clue_id, ts, label, s_i_tag_id, d_i_road_haul::FLOAT::DOUBLE AS d_i_road_haul,
  d_u_click_cnt_0_7::FLOAT::DOUBLE AS d_u_click_cnt_0_7 FROM features""")
def _(t):
    rows = P.cast_families(t.features, P.feature_families(t.features))
    return rows.select("user_id", "clue_id", "ts", "label", "s_i_tag_id", *[
        F.col(c).cast("double").alias(c) for c in ("d_i_road_haul", "d_u_click_cnt_0_7")])
