"""Scalar and array expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import RUN
from checks.q_operators import SEQS, parsed
from checks.registry import digits, digits_sql, query
from checks.tables_sql import price_case, score_case
from paddock import functions as X
from paddock.functions.scalars import ITEM_BUCKETS, PRICE_SHARES, USER_BUCKETS
from paddock.operators.encoding import encode_categories, encode_sequences
from paddock.plans.preprocess import attribute_of


@query("c1_score_segment", f"""
SELECT clue_id, evaluate_score, {score_case('evaluate_score')} AS segment
FROM items""")
def _(t):
    return t.items.select("clue_id", "evaluate_score", X.score_segment("evaluate_score").alias("segment"))


@query("c2_price_bin", f"""
SELECT clue_id, o, l, cast(model_price AS INT) AS model_price,
  {price_case('cast(model_price AS INT)')} AS bin FROM price_log""")
def _(t):
    price = X.safe_int("model_price")
    return t.price_log.select("clue_id", "o", "l", price.alias("model_price"),
                              X.price_bin(price).alias("bin"))


@query("c3_level_ordinal", """
SELECT clue_id, evaluate_level_segment AS ordinal FROM priced_run""")
def _(t):
    return t.items.select("clue_id", X.level_ordinal("evaluate_level").alias("ordinal"))


@query("c4_diff_price", "SELECT clue_id, seller_price - model_price AS diff_price FROM prices_run")
def _(t):
    return t.prices(RUN).select("clue_id", X.diff_price().alias("diff_price"))


@query("c5_on_shelf_days", f"""
SELECT clue_id, cast(DATE '{RUN}' - cast(create_time AS DATE) AS INT) AS days FROM items""")
def _(t):
    return t.items.select("clue_id", X.on_shelf_days(RUN).alias("days"))


@query("c6_year_from_title", r"""
SELECT clue_id, regexp_extract(title, '(\d+)款', 1) AS car_year FROM items""")
def _(t):
    return t.items.select("clue_id", X.year_from_title("title").alias("car_year"))


@query("c7_day_arith", """
SELECT user_id, clue_id, substr(create_time, 1, 10) AS day, ts AS seconds,
  strftime(cast(dt AS DATE) - 90, '%Y-%m-%d') AS earliest,
  strftime(cast(dt AS DATE) + 3, '%Y-%m-%d') AS latest FROM orders_in""")
def _(t):
    return t.orders.select(
        "user_id", "clue_id", F.substring("create_time", 1, 10).alias("day"),
        X.epoch_seconds("create_time").cast("int").alias("seconds"),
        X.day_shift("dt", -90).alias("earliest"), X.day_shift("dt", 3).alias("latest"))


@query("c9_pad_array", """
SELECT user_id, ts, clue_id, array_to_string(clues, ',') AS clues,
  cast(len(clues) AS INT) AS n FROM features""")
def _(t):
    """From the unpadded sequences; impressions without history get ten times 1."""
    from paddock.operators.joins import lookup_join
    from paddock.operators.sequences import last_items

    seqs = last_items(t.impressions, t.clicks, t.sequence_items, ["clue_id"])
    seqs = seqs.withColumnRenamed("clue_id", "clues")
    rows = lookup_join(t.impressions.select("user_id", "ts", "clue_id"), seqs, ["user_id", "ts"])
    padded = X.pad_array("clues", 10, "1")
    return rows.select("user_id", "ts", "clue_id", X.join_array(padded).alias("clues"),
                       F.size(padded).alias("n"))


@query("c10_join_array", """
SELECT user_id, ts, clue_id, coalesce(array_to_string(hauls, ','), '') AS hauls,
  coalesce(array_to_string(sellers, ','), '') AS sellers FROM features""")
def _(t):
    from paddock.operators.joins import lookup_join
    from paddock.operators.sequences import last_items

    seqs = last_items(t.impressions, t.clicks, t.sequence_items, ["road_haul", "seller_price"])
    rows = lookup_join(t.impressions.select("user_id", "ts", "clue_id"), seqs, ["user_id", "ts"])
    return rows.select("user_id", "ts", "clue_id", X.join_array("road_haul").alias("hauls"),
                       X.join_array("seller_price").alias("sellers"))


@query("c11_parse_array", f"""
SELECT user_id, ts, clue_id, cast(len(CASE WHEN len(sellers) > 0 THEN sellers END) AS INT) AS n,
  {digits_sql('CASE WHEN len(sellers) > 0 THEN sellers END')} AS cells FROM features""")
def _(t):
    arr = X.parse_array("d_seq_c2b_click_c2b_seller_price_seq", "double")
    return t.features.select("user_id", "ts", "clue_id",
                             F.when(arr.isNotNull(), F.size(arr)).alias("n"), digits(arr).alias("cells"))


@query("c12_pad_dense_global", f"""
SELECT user_id, ts, clue_id, cast(len(p) AS INT) AS n, {digits_sql('p')} AS cells FROM (SELECT user_id, ts, clue_id, list_concat(hauls::DOUBLE[],
  list_resize([]::DOUBLE[], 10 - coalesce(len(hauls), 0), 1234.5::DOUBLE)) AS p FROM features) f""")
def _(t):
    return _padded(t, X.pad_dense_global("d_seq_c2b_click_road_haul_seq", F.lit(1234.5)))


def _padded(t, arr):
    rows = parsed(t).withColumn("p", arr)
    return rows.select("user_id", "ts", "clue_id", F.size("p").alias("n"), digits("p").alias("cells"))


@query("c13_pad_dense_local", f"""
SELECT user_id, ts, clue_id, cast(len(p) AS INT) AS n, {digits_sql('p')} AS cells FROM (SELECT user_id, ts, clue_id, list_concat(hauls::DOUBLE[],
  list_resize([]::DOUBLE[], 10 - coalesce(len(hauls), 0), CASE WHEN len(hauls) > 0
  THEN list_median(hauls::DOUBLE[]) ELSE 1234.5::DOUBLE END)) AS p FROM features) f""")
def _(t):
    return _padded(t, X.pad_dense_local("d_seq_c2b_click_road_haul_seq", 1234.5))


@query("c14_map_array", """
SELECT user_id, ts, string_agg(cast(coalesce(c.encode_id, 1) AS VARCHAR), ',' ORDER BY rn) AS cities
FROM click_hist h JOIN items i ON h.clue_id = i.clue_id
LEFT JOIN codes c ON c.fea_name = 'city_id' AND c.fea_val = i.city_id WHERE rn <= 10 GROUP BY ALL""")
def _(t):
    return _mapped(t)


def _mapped(t, **kw):
    from paddock.operators.sequences import last_items

    raw = last_items(t.impressions, t.clicks, t.items, ["city_id"])
    out = encode_sequences(raw, {"city_id": "city_id"}, t.codes, **kw)
    return out.select("user_id", "ts", X.join_array("city_id").alias("cities"))


@query("c14_map_array_by_join", """
SELECT user_id, ts, string_agg(cast(coalesce(c.encode_id, 1) AS VARCHAR), ',' ORDER BY rn) AS cities
FROM click_hist h JOIN items i ON h.clue_id = i.clue_id
LEFT JOIN codes c ON c.fea_name = 'city_id' AND c.fea_val = i.city_id WHERE rn <= 10 GROUP BY ALL""")
def _(t):
    """With a declared key instead of row numbers."""
    return _mapped(t, key=["user_id", "ts"])


@query("c15_map_value", """
SELECT clue_id, coalesce(a.encode_id, 1) AS s_i_tag_id, coalesce(b.encode_id, 1) AS s_i_city_id
FROM items i LEFT JOIN codes a ON a.fea_name = 'tag_id' AND a.fea_val = i.tag_id
LEFT JOIN codes b ON b.fea_name = 'city_id' AND b.fea_val = i.city_id""")
def _(t):
    """The dictionary name is part of the column name."""
    rows = t.items.select("clue_id", F.col("tag_id").alias("s_i_tag_id"),
                          F.col("city_id").alias("s_i_city_id"))
    specs = {c: attribute_of(c) for c in ("s_i_tag_id", "s_i_city_id")}
    return encode_categories(rows, specs, t.codes, key="clue_id")


@query("c16_hash_bucket", """
SELECT l_orderkey, l_linenumber, l_partkey, cast(l_orderkey % 8001 AS INT) AS user_bucket,
  cast(l_partkey % 20001 AS INT) AS item_bucket FROM lineitem""")
def _(t):
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        X.hash_bucket("l_orderkey", USER_BUCKETS).alias("user_bucket"),
        X.hash_bucket("l_partkey", ITEM_BUCKETS).alias("item_bucket"))


@query("c17_standardize", """
SELECT clue_id, round((road_haul - 25000.0::DOUBLE) / 12000.0::DOUBLE, 6) AS road_haul FROM items""")
def _(t):
    return t.items.select("clue_id", F.round(
        X.standardize("road_haul", F.lit(25000.0), F.lit(12000.0)), 6).alias("road_haul"))


@query("c18_standardize_array", f"""
SELECT user_id, ts, clue_id, {digits_sql('list_transform(hauls, lambda x: (x - 25000.0::DOUBLE) / 12000.0::DOUBLE)')} AS cells
FROM features WHERE len(hauls) > 0""")
def _(t):
    seq = list(SEQS)[0]
    rows = parsed(t).where(F.col(seq).isNotNull())
    out = X.standardize_array(seq, F.lit(25000.0), F.lit(12000.0))
    return rows.select("user_id", "ts", "clue_id", digits(out).alias("cells"))


@query("c19_price_reached", """
SELECT e.clue_id, e.user_id, e.recommend_id, e.amount, p.model_price,
  CASE WHEN p.model_price > 0 AND e.amount > p.model_price * 0.8::DOUBLE THEN 1 ELSE 0 END AS is_daojia80,
  CASE WHEN p.model_price > 0 AND e.amount > p.model_price * 0.9::DOUBLE THEN 1 ELSE 0 END AS is_daojia90,
  CASE WHEN p.model_price > 0 AND e.amount > p.model_price THEN 1 ELSE 0 END AS is_daojia100
FROM label_events e LEFT JOIN prices_run p ON e.clue_id = p.clue_id WHERE e.action = 'bid'""")
def _(t):
    from paddock.operators.joins import lookup_join
    from paddock.plans.samples import label_events

    bids = label_events(t.behaviour).where("action = 'bid'").select(
        "clue_id", "user_id", "recommend_id", "amount")
    rows = lookup_join(bids, t.prices(RUN).select("clue_id", "model_price"), "clue_id")
    return rows.select("clue_id", "user_id", "recommend_id", "amount", "model_price", *[
        X.price_reached(share).alias(name) for name, share in PRICE_SHARES.items()])


@query("c20_cosine", """
SELECT n.vec_id, round(list_cosine_similarity(n.embedding::DOUBLE[], o.embedding), 6) AS cosine
FROM embeddings n JOIN old_vectors o ON n.vec_id = o.vec_id""")
def _(t):
    old = t.old_vectors.withColumnRenamed("embedding", "old")
    return t.vectors.join(old, "vec_id").select(
        "vec_id", F.round(X.cosine("embedding", "old"), 6).alias("cosine"))


@query("c21_dot", """
SELECT n.vec_id, round(list_dot_product(n.embedding::DOUBLE[], o.embedding), 6) AS dot
FROM embeddings n JOIN old_vectors o ON n.vec_id = o.vec_id""")
def _(t):
    old = t.old_vectors.withColumnRenamed("embedding", "old")
    return t.vectors.join(old, "vec_id").select(
        "vec_id", F.round(X.dot("embedding", "old"), 6).alias("dot"))


@query("c22_sigmoid", "SELECT vec_id, round(1 / (1 + exp(-embedding[1]::DOUBLE)), 6) AS p FROM embeddings")
def _(t):
    return t.vectors.select("vec_id", F.round(
        X.sigmoid(F.get("embedding", F.lit(0)).cast("double")), 6).alias("p"))


@query("c23_vector_text", f"""
SELECT vec_id, cast(len(embedding) AS INT) AS n, {digits_sql('embedding')} AS cells,
  '[' AS opening, ']' AS closing FROM embeddings""")
def _(t):
    text = t.vectors.withColumn("text", X.vector_to_text("embedding"))
    back = X.text_to_vector("text")  # float again: the text is that of floats
    return text.select("vec_id", F.size(back).alias("n"), digits(back).alias("cells"),
                       F.substring("text", 1, 1).alias("opening"),
                       F.right("text", F.lit(1)).alias("closing"))


@query("c24_round4", "SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS x FROM embeddings")
def _(t):
    return t.vectors.select("vec_id", X.round4(
        F.get("embedding", F.lit(0)).cast("double")).alias("x"))
