"""Joins, aggregates, windows, order, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import RUN, SNAP
from checks.registry import query
from checks.tables_sql import draw, unit
from paddock.operators import aggregates as A
from paddock.operators import encoding as E
from paddock.operators import filters as P
from paddock.operators import joins as J
from paddock.operators import ordering as O
from paddock.operators import quantiles as QU
from paddock.operators import sampling as R
from paddock.operators import sequences as Q
from paddock.operators import windows as W
from paddock.operators.compare import changed_embeddings, refresh_all
from paddock.plans import names as N
from paddock.plans import samples as SP
from paddock.plans.histories import action_events
from paddock.plans.items import priced_items

ITEM_COLS = ["tag_id", "auto_type", "seats", "road_haul", "evaluate_score", "model_price"]


@query("j1_join_item_features", """
SELECT s.dt, s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, tag_id, auto_type, seats,
  road_haul, evaluate_score, model_price
FROM samples s LEFT JOIN priced_run i ON s.clue_id = i.clue_id""")
def _(t):
    return J.join_item_features(t.samples, t.priced(RUN).select("clue_id", *ITEM_COLS))


@query("j2_join_user_features", """
SELECT s.dt, s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, d_u_click_cnt_0_7,
  d_u_click_road_haul_median_0_30, s_u_bid_tag_id_0_7
FROM samples s LEFT JOIN users u ON s.user_id = u.user_id""")
def _(t):
    users = t.users(SNAP).select(
        "user_id", "d_u_click_cnt_0_7", "d_u_click_road_haul_median_0_30", "s_u_bid_tag_id_0_7")
    return J.join_user_features(t.samples, users)


def _seq(action):
    return f"""
SELECT m.user_id, m.ts, array_to_string(list(e.clue_id ORDER BY e.ts DESC, e.clue_id DESC)[1:10], ',')
  AS {action}_items
FROM (SELECT DISTINCT user_id, ts FROM samples) m JOIN
  (SELECT cast(user_id AS INT) AS user_id, cast(clue_id AS INT) AS clue_id, cast(ts AS INT) AS ts
   FROM behaviour WHERE action = '{action}') e
ON m.user_id = e.user_id AND m.ts > e.ts + 60 GROUP BY m.user_id, m.ts"""


@query("j3_join_sequences", f"""
SELECT s.dt, s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, click_items, bid_items, order_items
FROM samples s LEFT JOIN ({_seq('click')}) a ON s.user_id = a.user_id AND s.ts = a.ts
LEFT JOIN ({_seq('bid')}) b ON s.user_id = b.user_id AND s.ts = b.ts
LEFT JOIN ({_seq('order')}) c ON s.user_id = c.user_id AND s.ts = c.ts""")
def _(t):
    """Three sequence frames joined on (user, moment)."""
    parts = []
    for a in ("click", "bid", "order"):
        events = P.int_ids(t.behaviour.where(F.col("action") == a), ["user_id", "clue_id", "ts"])
        h = Q.last_k_before(t.samples, events)
        text = F.array_join(F.col("hist.clue_id").cast("array<string>"), ",")
        parts.append(h.where(F.size("hist") > 0).select(
            "user_id", "ts", text.alias(f"{a}_items")))
    return J.join_sequences(t.samples, *parts)


@query("j4_eligible_items", """
SELECT dt, user_id, recommend_id, page, query_ts, cast(n AS BIGINT) AS n FROM counted""")
def _(t):
    """Requests with the number of items on sale before them, without making the pairs."""
    return R.eligible_items(*SP.requests_and_items(t.behaviour)).select(
        "dt", "user_id", "recommend_id", "page", "query_ts", "n")


@query("j5_point_in_time", """
SELECT user_id, ts, cast(rn AS INT) AS rn, clue_id FROM click_hist WHERE rn <= 10""")
def _(t):
    return Q.point_in_time(t.impressions, t.clicks).select("user_id", "ts", "rn", "clue_id")


def _coded(cols):
    return ", ".join(f"coalesce({a}_c.encode_id, 1) AS {a}" for a in cols), " ".join(
        f"LEFT JOIN codes {a}_c ON {a}_c.fea_name = '{d}' AND {a}_c.fea_val = cast(p.{a} AS VARCHAR)"
        for a, d in cols.items())


ITEM_CODES = {a: d for a, _, d in N.ITEM_SPARSE}


@query("j6_encode_categories", f"""
SELECT p.clue_id, {_coded(ITEM_CODES)[0]} FROM priced_run p {_coded(ITEM_CODES)[1]}""")
def _(t):
    return E.encode_categories(
        t.priced(RUN).select("clue_id", *ITEM_CODES), ITEM_CODES, t.codes, key="clue_id")


@query("j6_encode_by_join", f"""
SELECT p.clue_id, {_coded(ITEM_CODES)[0]} FROM priced_run p {_coded(ITEM_CODES)[1]}""")
def _(t):
    """Without a declared key: rows are numbered."""
    return E.encode_categories(
        t.priced(RUN).select("clue_id", *ITEM_CODES), ITEM_CODES, t.codes, key=None)


@query("j7_assemble_user", """
SELECT b.user_id, b.n AS beseen, c.n AS click, d.n AS bid, o.cnt_0_30 AS orders_30
FROM (SELECT user_id, cnt_0_7 AS n FROM action_cnt WHERE action = 'beseen') b
LEFT JOIN (SELECT user_id, cnt_0_7 AS n FROM action_cnt WHERE action = 'click') c ON b.user_id = c.user_id
LEFT JOIN (SELECT user_id, cnt_0_7 AS n FROM action_cnt WHERE action = 'bid') d ON b.user_id = d.user_id
LEFT JOIN convert_cnt o ON b.user_id = o.user_id""")
def _(t):
    rows = t.action_cnt(SNAP)
    parts = {
        a: rows.where(F.col("action") == a).groupBy("user_id").agg(F.max("cnt_0_7").alias(a))
        for a in ("beseen", "click", "bid")
    }
    orders = t.convert_cnt(SNAP).select("user_id", F.col("cnt_0_30").alias("orders_30"))
    return J.assemble_user(parts["beseen"], parts["click"], parts["bid"], orders)


@query("j9_attach_labels", """
SELECT dt, clue_id, user_id, recommend_id, ts, is_click, is_quick_collection, is_bid, is_daojia80,
  is_daojia90, is_daojia100 FROM impressions""")
def _(t):
    events = SP.label_events(t.behaviour)
    seen = events.where("action = 'beseen'").select("dt", "clue_id", "user_id", "recommend_id", "ts")
    return J.attach_labels(seen, SP.label_flags(events, t.day_prices), ["dt", "clue_id", "recommend_id"])


@query("j10_sequence_items", """
SELECT b.user_id, b.clue_id, b.ts, tag_id, road_haul FROM clicks b
JOIN items i ON b.clue_id = i.clue_id WHERE i.create_time > '2024'""")
def _(t):
    """Clicks on items that are not in the (recent) table disappear."""
    recent = P.recent_items(t.items, "2024").select("clue_id", "tag_id", "road_haul")
    return J.sequence_items(t.clicks, recent)


@query("j11_join_latest_price", """
SELECT clue_id, tag_id, model_price, seller_price, car_level, diff_price FROM priced_run""")
def _(t):
    from paddock.plans.items import latest_prices
    from checks.fixtures import PRICE_TIES

    prices = latest_prices(t.price_log, RUN, ties=PRICE_TIES)
    return J.join_latest_price(t.items.select("clue_id", "tag_id"), prices).withColumn(
        "diff_price", F.col("seller_price") - F.col("model_price"))


@query("j12_join_item_rates", """
SELECT i.clue_id, round(click_bid_rate_0_3, 6) AS click_bid_rate_0_3,
  round(beseen_click_rate_0_30, 6) AS beseen_click_rate_0_30,
  round(tag_id_bid_percent_ratio_7_14, 6) AS tag_id_bid_percent_ratio_7_14,
  round(tag_id_click_rate_0_7, 6) AS tag_id_click_rate_0_7,
  round(minor_category_id_click_rate_0_7, 6) AS minor_category_id_click_rate_0_7
FROM items i LEFT JOIN rates_0 a ON i.clue_id = a.clue_id
LEFT JOIN rates_1 b ON i.clue_id = b.clue_id LEFT JOIN rates_2 c ON i.clue_id = c.clue_id""")
def _(t):
    cols = ("click_bid_rate_0_3", "beseen_click_rate_0_30", "tag_id_bid_percent_ratio_7_14",
            "tag_id_click_rate_0_7", "minor_category_id_click_rate_0_7")
    return J.join_item_rates(t.items.select("clue_id"), *t.rates(SNAP)).select(
        "clue_id", *[F.round(c, 6).alias(c) for c in cols])


COS = """CASE WHEN o.vec_id IS NULL THEN 'new' WHEN list_cosine_similarity(n.embedding::DOUBLE[],
  o.embedding) < 1 - 1e-6 THEN 'changed' END"""


@query("j13_changed_embeddings", f"""
SELECT * FROM (SELECT n.vec_id, {COS} AS reason FROM embeddings n
LEFT JOIN old_vectors o ON n.vec_id = o.vec_id) d WHERE reason IS NOT NULL""")
def _(t):
    return changed_embeddings(t.vectors, t.old_vectors, "vec_id").select("vec_id", "reason")


@query("j14_refresh_all", """
SELECT n.vec_id, CASE WHEN o.vec_id IS NULL THEN 'new' ELSE 'existing' END AS reason
FROM embeddings n LEFT JOIN old_vectors o ON n.vec_id = o.vec_id""")
def _(t):
    return refresh_all(t.vectors, t.old_vectors, "vec_id").select("vec_id", "reason")


# -- aggregates ---------------------------------------------------------------------------


@query("a1_first_seen", "SELECT dt, clue_id, on_sale_ts FROM on_shelf")
def _(t):
    return SP.requests_and_items(t.behaviour)[1]


@query("a2_query_heads", "SELECT dt, user_id, recommend_id, page, query_ts FROM heads")
def _(t):
    return SP.requests_and_items(t.behaviour)[0]


@query("a3_distinct_rows", "SELECT DISTINCT user_id, recommend_id, page FROM behaviour")
def _(t):
    return A.distinct_rows(t.behaviour, ["user_id", "recommend_id", "page"])


COUNT_COLS = {**N.action_count_columns(), **{
    f"d_u_collect_cnt_{w}": ("quick_collection", f"cnt_{w}") for w in ("0_7", "7_14", "14_30")}}


@query("a4_pivot_max", "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN action = '{a}' THEN {c} ELSE 0 END) AS {n}"
    for n, (a, c) in COUNT_COLS.items()) + " FROM action_cnt GROUP BY user_id")
def _(t):
    return A.pivot_max(t.action_cnt(SNAP), "user_id", COUNT_COLS)


STAT_COLS = N.action_stat_columns()


def _stat_sql():
    groups: dict = {}
    for n, (a, d, c) in STAT_COLS.items():
        groups.setdefault((a, d), []).append(f"{c} AS {n}")
    joins = " ".join(
        f"LEFT JOIN (SELECT user_id, {', '.join(cols)} FROM action_statis WHERE action = '{a}' "
        f"AND cnt_days = {d}) s{i} ON u.user_id = s{i}.user_id"
        for i, ((a, d), cols) in enumerate(groups.items()))
    return (f"SELECT u.user_id, {', '.join(STAT_COLS)} FROM "
            f"(SELECT DISTINCT user_id FROM action_statis) u {joins}")


@query("a5_pivot_stats", _stat_sql())
def _(t):
    return A.pivot_stats(t.action_statis(SNAP), "user_id", STAT_COLS)


ANY_WINDOW = {
    f"{a}_{m}_{s}": (a, f"{m}_{src}")
    for a in ("click", "bid") for m in N.REFRESH_MEASURES for s, src in N.STATS.items()}


@query("a6_pivot_stats_any_window", "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN action = '{a}' THEN {c} ELSE 0 END)::DOUBLE AS {n}"
    for n, (a, c) in ANY_WINDOW.items()) + " FROM action_statis GROUP BY user_id")
def _(t):
    out = A.pivot_max(t.action_statis(SNAP), "user_id", ANY_WINDOW)
    return out.select("user_id", *[F.col(c).cast("double").alias(c) for c in ANY_WINDOW])


FAVOURITES = N.action_favourites()
FAV_SQL = """SELECT r.user_id, {cols} FROM action_ratio r JOIN (SELECT user_id, action, cluster,
  max(ratio_0_7) AS top FROM action_ratio GROUP BY ALL) b ON r.user_id = b.user_id
  AND r.action = b.action AND r.cluster = b.cluster AND r.ratio_0_7 = b.top GROUP BY r.user_id"""
FAV_ARM = "max(CASE WHEN r.action = '{a}' AND r.cluster = '{c}' AND top > 0 THEN {key} END)"


@query("a7_favourite", FAV_SQL.format(cols=", ".join(
    f"coalesce({FAV_ARM.format(a=a, c=c, key='r.key')}, '-1') AS {n}"
    for n, (a, c) in FAVOURITES.items())))
def _(t):
    return A.favourite(t.action_ratio(SNAP), "ratio_0_7", FAVOURITES)


SHIFTED = {f"{a}_{c}": (a, c) for a in ("click", "bid")
           for c in ("evaluate_level_segment", "tag_id")}
SHIFT = [n for n, (a, c) in SHIFTED.items() if c == "evaluate_level_segment"]


@query("a8_favourite_shifted", FAV_SQL.format(cols=", ".join(
    (f"coalesce(cast({FAV_ARM.format(a=a, c=c, key='r.key')} AS INT) + 1, 1) AS {n}" if n in SHIFT else
     f"coalesce({FAV_ARM.format(a=a, c=c, key='r.key')}, '-1') AS {n}")
    for n, (a, c) in SHIFTED.items())))
def _(t):
    return A.favourite(t.action_ratio(SNAP), "ratio_0_7", SHIFTED, shift=SHIFT)


RECENT = {"hauls": "road_haul_{stat}", "sellers": "seller_price_{stat}"}


@query("a9_recent_stats", """
SELECT h.user_id, h.ts, round(avg(road_haul), 6) AS road_haul_avg,
  round(avg(seller_price), 6) AS seller_price_avg, max(road_haul) AS road_haul_max,
  max(seller_price) AS seller_price_max, min(road_haul) AS road_haul_min,
  min(seller_price) AS seller_price_min, quantile_disc(road_haul, 0.5) AS road_haul_p50,
  quantile_disc(seller_price, 0.5) AS seller_price_p50
FROM click_hist h JOIN seq_items i ON h.clue_id = i.clue_id WHERE rn <= 10 GROUP BY ALL""")
def _(t):
    seqs = Q.last_items(t.impressions, t.clicks, t.sequence_items, ["road_haul", "seller_price"])
    seqs = seqs.withColumnsRenamed({"road_haul": "hauls", "seller_price": "sellers"})
    out = Q.recent_stats(seqs, RECENT, keep=["user_id", "ts"])
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("_avg") else F.col(c)
                        for c in out.columns])


@query("a10_collect_ordered", """
SELECT user_id, ts, array_to_string(clues, ',') AS clues, array_to_string(tags, ',') AS tags,
  array_to_string(list_transform(sellers, lambda x: coalesce(x, -1)), ',') AS sellers FROM click_seqs""")
def _(t):
    rows = Q.point_in_time(t.impressions, t.clicks)
    items = t.sequence_items.select("clue_id", "tag_id", "seller_price")
    rows = J.sequence_items(rows, items)
    out = Q.collect_ordered(rows, ["user_id", "ts"], "rn", ["clue_id", "tag_id", "seller_price"])

    def text(c):
        known = F.transform(c, lambda x: F.coalesce(x, F.lit(-1)).cast("string"))
        return F.array_join(known, ",")

    return out.select("user_id", "ts", text("clue_id").alias("clues"),
                      text("tag_id").alias("tags"), text("seller_price").alias("sellers"))


DENSE = ["d_u_click_cnt_0_7", "d_u_click_road_haul_max_0_7", "d_i_c2b_evaluate_score",
         "d_i_c2b_ctob_model_price", "d_i_road_haul"]
SEQS = {"d_seq_c2b_click_road_haul_seq": "hauls",
        "d_seq_c2b_click_c2b_seller_price_seq": "sellers"}


def parsed(t):
    from paddock.functions import parse_array

    return t.features.withColumns({c: parse_array(c, "double") for c in SEQS})


@query("a11_fit_medians", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median({c}), 6)::DOUBLE AS median FROM features" for c in DENSE))
def _(t):
    return QU.fit_medians(t.features, DENSE).select("feature", F.round("median", 6).alias("median"))


@query("a12_fit_seq_medians", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median(x), 6)::DOUBLE AS median FROM (SELECT unnest({s}) AS x "
    f"FROM features) e" for c, s in SEQS.items()))
def _(t):
    return QU.fit_medians(parsed(t), seqs=list(SEQS)).select(
        "feature", F.round("median", 6).alias("median"))


@query("a13_fit_scaler", "WITH m AS (SELECT " + ", ".join(
    f"median({c}) AS {c}" for c in DENSE) + " FROM features) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(coalesce(f.{c}, m.{c})), 6) AS mean, "
    f"round(stddev_pop(coalesce(f.{c}, m.{c})), 6) AS scale FROM features f, m" for c in DENSE))
def _(t):
    """After filling with the medians; one row of the aggregate becomes rows again."""
    from paddock.plans.preprocess import fill_missing

    medians = {r["feature"]: r["median"] for r in QU.fit_medians(t.features, DENSE).collect()}
    families = {"d_u": DENSE, "d_i": [], "d_seq": []}
    filled = fill_missing(t.features, families, medians)
    out = A.scaler_long(QU.long_values(filled, DENSE))
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


@query("a14_fit_seq_scaler", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS scale
FROM (SELECT unnest(list_concat({s}::DOUBLE[], list_resize([]::DOUBLE[], 10 - coalesce(len({s}), 0),
  (SELECT median(y)::DOUBLE FROM (SELECT unnest({s}) AS y FROM features) q)))) AS x FROM features) e"""
    for c, s in SEQS.items()))
def _(t):
    from paddock.plans.preprocess import fill_missing

    rows = parsed(t)
    medians = {r["feature"]: r["median"] for r in QU.fit_medians(rows, seqs=list(SEQS)).collect()}
    filled = fill_missing(rows, {"d_u": [], "d_i": [], "d_seq": list(SEQS)}, medians)
    out = A.scaler_long(QU.long_values(filled, seqs=list(SEQS)))
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


@query("a15_fit_trimmed_scaler", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS scale
FROM features, (SELECT quantile_cont({c}::DOUBLE, 0.03) AS lo, quantile_cont({c}::DOUBLE, 0.97) AS hi
  FROM features) b WHERE {c} BETWEEN lo AND hi""" for c in DENSE))
def _(t):
    out = QU.fit_trimmed_scaler(t.features, DENSE)
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


@query("a16_label_balance", "SELECT label, count(*) AS n FROM samples GROUP BY label")
def _(t):
    return A.label_balance(t.samples)


ORDERED = """
SELECT *, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.9::DOUBLE)
  THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY ts, user_id, clue_id, recommend_id) AS rn,
  count(*) OVER () AS n FROM impressions) o"""


@query("a17_split_counts", f"SELECT split, count(*) AS n FROM ({ORDERED}) s GROUP BY split")
def _(t):
    return A.split_counts(O.time_split(t.impressions))


# -- windows ------------------------------------------------------------------------------


@query("w1_latest_per_key", """
SELECT clue_id, ts, model_price, seller_price FROM (SELECT *, row_number() OVER (PARTITION BY clue_id
  ORDER BY ts DESC, o DESC, l DESC, x DESC) AS rn FROM price_log) p WHERE rn = 1""")
def _(t):
    return W.latest_per_key(t.price_log, "clue_id", ties=["o", "l", "x"]).select(
        "clue_id", "ts", "model_price", "seller_price")


@query("w2_first_per_key", """
SELECT clue_id, user_id, recommend_id, action, ts, amount FROM label_events""")
def _(t):
    return SP.label_events(t.behaviour).select(
        "clue_id", "user_id", "recommend_id", "action", "ts", "amount")


@query("w3_random_one_per_group", f"""
SELECT recommend_id, page, clue_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY recommend_id,
  page ORDER BY {draw(5, 'recommend_id', 'page', 'clue_id', 'ts')}, recommend_id, page, clue_id, ts)
  AS rn FROM behaviour) b WHERE rn = 1""")
def _(t):
    out = W.random_one_per_group(
        t.behaviour, ["recommend_id", "page"], 5, ["recommend_id", "page", "clue_id", "ts"])
    return out.select("recommend_id", "page", "clue_id", "ts")


@query("w4_last_k_history", """
SELECT user_id, clue_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, clue_id DESC) AS rn FROM clicks) c WHERE rn <= 10""")
def _(t):
    return W.last_k_history(t.clicks).select("user_id", "clue_id", "ts")


@query("w5_last_k_before", """
SELECT m.user_id, m.ts, coalesce(array_to_string(list(h.clue_id ORDER BY rn)
  FILTER (h.clue_id IS NOT NULL), ','), '') AS clues
FROM (SELECT DISTINCT user_id, ts FROM impressions) m
LEFT JOIN (SELECT * FROM click_hist WHERE rn <= 10) h ON m.user_id = h.user_id AND m.ts = h.ts
GROUP BY m.user_id, m.ts""")
def _(t):
    out = Q.last_k_before(t.impressions, t.clicks)
    return out.select("user_id", "ts", F.array_join(
        F.col("hist.clue_id").cast("array<string>"), ",").alias("clues"))


# -- order, sampling, sets --------------------------------------------------------------------


@query("t1_bernoulli", f"""
SELECT user_id, recommend_id, page, action, ts FROM behaviour
WHERE {unit(3, 'user_id', 'recommend_id', 'page')} <= 0.3""")
def _(t):
    out = R.bernoulli(t.behaviour, 0.3, 3, ["user_id", "recommend_id", "page"])
    return out.select("user_id", "recommend_id", "page", "action", "ts")


@query("t2_shuffle_rows", "SELECT dt, user_id, clue_id, recommend_id, label, ts FROM samples")
def _(t):
    return O.shuffle_rows(t.samples, 11)


@query("t3_time_split", f"""
SELECT user_id, clue_id, recommend_id, ts, split FROM ({ORDERED}) s""")
def _(t):
    return O.time_split(t.impressions).select("user_id", "clue_id", "recommend_id", "ts", "split")


@query("u1_union_labels", "SELECT dt, user_id, clue_id, recommend_id, label, ts FROM samples")
def _(t):
    heads, items = SP.requests_and_items(t.behaviour)
    negatives = R.sampled_negatives(heads, items).select(
        "dt", "user_id", "clue_id", "recommend_id", F.lit(0).alias("label"),
        F.col("query_ts").alias("ts"))
    return R.union_labels(SP.positives(t.behaviour), negatives)


@query("u2_union_history_today", f"""
SELECT user_id, action, ts, clue_id FROM (SELECT cast(user_id AS INT) AS user_id, action,
  cast(ts AS INT) AS ts, cast(clue_id AS INT) AS clue_id, row_number() OVER (PARTITION BY user_id,
  action ORDER BY cast(ts AS INT) DESC, cast(clue_id AS INT) DESC) AS rn FROM behaviour
  WHERE action IN ('click', 'bid') AND dt BETWEEN '2023-12-29' AND '{SNAP}') h WHERE rn <= 10
UNION ALL SELECT cast(user_id AS INT), action, cast(ts AS INT), cast(clue_id AS INT) FROM behaviour
WHERE action IN ('click', 'bid') AND dt = '{RUN}'""")
def _(t):
    return action_events(t.behaviour, RUN)
