"""The same derived inputs in SQL, as named common table expressions."""

from __future__ import annotations

import re

from paddock.plans import names as N

RUN, SNAP = "2024-01-27", "2024-01-26"


def draw(seed, *keys) -> str:
    """32-bit draw, as ``paddock.functions.hash32``."""
    parts = ", ".join(f"coalesce(cast({k} AS VARCHAR), '')" for k in keys)
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, 8))::BIGINT)"


def unit(seed, *keys) -> str:
    return f"(({draw(seed, *keys)} + 1)::DOUBLE / 4294967296.0::DOUBLE)"


# The bins are stated here once more: a wrong bound on one side shows.


def score_case(x) -> str:
    return (f"CASE WHEN {x} BETWEEN 0 AND 55 THEN 35 WHEN {x} > 55 AND {x} <= 69 THEN 65 "
            f"WHEN {x} > 69 AND {x} <= 89 THEN 80 WHEN {x} > 89 AND {x} <= 100 THEN 95 ELSE -1 END")


def price_case(x) -> str:
    return (f"CASE WHEN {x} <= 0 OR {x} > 10000000 OR {x} IS NULL THEN -1 WHEN {x} <= 20000 THEN 2 "
            f"WHEN {x} <= 40000 THEN 4 WHEN {x} <= 60000 THEN 6 WHEN {x} <= 90000 THEN 9 "
            f"WHEN {x} <= 150000 THEN 15 ELSE 1000 END")


def priced_sql(prices: str) -> str:
    return f"""
SELECT i.*, p.model_price, p.seller_price, p.car_level,
  p.seller_price - p.model_price AS diff_price,
  CASE evaluate_level WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 ELSE 0 END
    AS evaluate_level_segment,
  {score_case("evaluate_score")} AS evaluate_score_segment,
  {price_case("model_price")} AS model_price_bin
FROM items i LEFT JOIN {prices} p ON i.clue_id = p.clue_id"""


def prices_sql(day: str) -> str:
    return f"""
SELECT cast(clue_id AS INT) AS clue_id, cast(model_price AS INT) AS model_price,
  cast(seller_price AS INT) AS seller_price, cast(car_level AS INT) AS car_level
FROM (SELECT *, row_number() OVER (PARTITION BY clue_id ORDER BY ts DESC, o DESC, l DESC, x DESC) AS rn
      FROM price_log
      WHERE dt BETWEEN strftime(DATE '{day}' - INTERVAL 90 DAY, '%Y-%m-%d') AND '{day}') t
WHERE rn = 1"""


DICTIONARY_ATTRIBUTES = {
    **{d: a for a, _, d in N.ITEM_SPARSE},
    "evaluate_level": "evaluate_level", "car_level": "car_level",
    "c2b_evaluate_level_segment": "evaluate_level_segment",
}

WINDOWS = {"0_3": (0, 2), "0_7": (0, 6), "7_14": (7, 13), "14_30": (14, 29), "0_30": (0, 29),
           "0_365": (0, 364)}
SAFE = "CASE WHEN {d} > 0 THEN {n} / {d}::DOUBLE ELSE 0.0::DOUBLE END"


def ratio(n, d) -> str:
    return SAFE.format(n=n, d=d)


def cnt(action, w) -> str:
    lo, hi = WINDOWS[w]
    return f"sum(CASE WHEN action = '{action}' AND age BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END)"


def statis_sql(where, windows, extra) -> str:
    parts = []
    for days, (lo, hi) in windows.items():
        parts.append(f"""
SELECT user_id, {extra}, {days} AS cnt_days,
  max(suggest_price) AS suggest_price_max, min(suggest_price) AS suggest_price_min,
  round(quantile_cont(suggest_price::DOUBLE, 0.5), 6) AS suggest_price_p50,
  max(road_haul) AS road_haul_max, min(road_haul) AS road_haul_min,
  round(quantile_cont(road_haul::DOUBLE, 0.5), 6) AS road_haul_p50,
  max(evaluate_score) AS evaluate_score_max, min(evaluate_score) AS evaluate_score_min,
  round(quantile_cont(evaluate_score::DOUBLE, 0.5), 6) AS evaluate_score_p50
FROM acted a JOIN items i ON a.clue_id = i.clue_id
WHERE {where} AND age BETWEEN {lo} AND {hi} GROUP BY ALL""")
    return " UNION ALL ".join(parts)


def ratio_sql(where, windows, clusters, by) -> str:
    legs = " UNION ALL ".join(
        f"SELECT {by}, age, '{c}' AS cluster, cast({c} AS VARCHAR) AS key FROM acted a "
        f"JOIN priced_snap i ON a.clue_id = i.clue_id WHERE {where}"
        for c in clusters)
    sums = ", ".join(
        f"sum(CASE WHEN age BETWEEN {WINDOWS[w][0]} AND {WINDOWS[w][1]} THEN 1 ELSE 0 END) AS c_{w}"
        for w in windows)
    out = ", ".join(
        ratio(f"c_{w}", f"(sum(c_{w}) OVER (PARTITION BY {by}, cluster))") + f" AS ratio_{w}"
        for w in windows)
    return f"""
SELECT {by}, cluster, key, {out}
FROM (SELECT {by}, cluster, key, {sums} FROM ({legs}) e WHERE key IS NOT NULL GROUP BY ALL) g"""


def _rates_sql(key) -> str:
    sums = ", ".join(
        f"{cnt(a, w)} AS {a}_{w}" for a in ("beseen", "click", "bid") for w in WINDOWS)
    source = "acted" if key == "clue_id" else "acted a JOIN items i ON a.clue_id = i.clue_id"
    return f"SELECT {key}, {sums} FROM {source} GROUP BY {key}"


def dictionary_sql() -> str:
    legs = " UNION ".join(
        f"SELECT v.dt, '{d}' AS fea_name, cast({a} AS VARCHAR) AS fea_val FROM priced_run, versions v "
        f"WHERE {a} IS NOT NULL AND ('0x' || substr(md5(v.seed || '|{d}|' || cast({a} AS VARCHAR)), 1, 8))::BIGINT % 16 <> 0"
        for d, a in DICTIONARY_ATTRIBUTES.items())
    return f"""
SELECT dt, fea_name, fea_val,
  cast(dense_rank() OVER (PARTITION BY dt, fea_name ORDER BY fea_val) + 1 AS INT) AS encode_id
FROM ({legs}) d"""


def code_of(value, feature) -> str:
    """Dictionary lookup with 1 for unknown, as a correlated lookup in a map."""
    return f"coalesce(element_at((SELECT m FROM code_maps WHERE fea_name = '{feature}'), cast({value} AS VARCHAR))[1], 1)"


def user_features_sql() -> str:
    """Six filtered selects of the statistics and best ratios joined back to their rows."""
    cols, joins = [], []
    counts = N.action_count_columns()
    pivot = ", ".join(
        f"max(CASE WHEN action = '{a}' THEN {c} ELSE 0 END) AS {n}" for n, (a, c) in counts.items())
    for n, (a, _) in counts.items():
        cols.append(n if a == "beseen" else f"coalesce({n}, 0)::DOUBLE AS {n}")
    cols += ["coalesce(c.cnt_0_30, 0)::DOUBLE AS d_u_contract_cnt_30",
             "coalesce(c.cnt_0_365, 0)::DOUBLE AS d_u_contract_cnt_365"]
    groups: dict = {}
    for table, spec in (("action_statis", N.action_stat_columns()),
                        ("convert_statis", N.order_stat_columns())):
        for n, (a, days, src) in spec.items():
            groups.setdefault((table, a, days), []).append(f"{src} AS {n}")
            cols.append(n)
    for i, ((table, a, days), names) in enumerate(groups.items()):
        word = "action" if table == "action_statis" else "convert"
        joins.append(
            f"LEFT JOIN (SELECT user_id, {', '.join(names)} FROM {table} "
            f"WHERE {word} = '{a}' AND cnt_days = {days}) s{i} ON u.user_id = s{i}.user_id")
    legs = (("f0", "action_ratio", "ratio_0_7", N.action_favourites(), True),
            ("f1", "convert_ratio", "ratio_0_30", N.order_favourites("0_30"), False),
            ("f2", "convert_ratio", "ratio_0_365", N.order_favourites("0_365"), False))
    for alias, table, r, spec, acted in legs:
        key = "user_id, action, cluster" if acted else "user_id, cluster"
        on = " AND ".join(f"b.{k} = t.{k}" for k in key.split(", "))
        arms = []
        for n, values in spec.items():
            cond = f"t.cluster = '{values[-1]}'" + (f" AND t.action = '{values[0]}'" if acted else "")
            arms.append(f"coalesce(max(CASE WHEN {cond} AND b.top > 0 THEN t.key END), '-1') AS {n}")
            cols.append(f"CASE WHEN {alias}.user_id IS NULL THEN 1 ELSE "
                        + code_of(f"{alias}.{n}", N.cluster_name(values[-1])) + f" END AS {n}")
        joins.append(
            f"LEFT JOIN (SELECT t.user_id, {', '.join(arms)} FROM {table} t JOIN "
            f"(SELECT {key}, max({r}) AS top FROM {table} GROUP BY {key}) b "
            f"ON {on} AND t.{r} = b.top GROUP BY t.user_id) {alias} ON u.user_id = {alias}.user_id")
    return (f"SELECT u.user_id, {', '.join(cols)} FROM (SELECT user_id, {pivot} FROM action_cnt "
            f"GROUP BY user_id) u LEFT JOIN convert_cnt c ON u.user_id = c.user_id "
            + " ".join(joins))


def item_table_sql(priced: str, where: str = "TRUE") -> str:
    sparse = ", ".join(f"{code_of('p.' + a, d)} AS {f}" for a, f, d in N.ITEM_SPARSE)
    rates = ", ".join(f"coalesce({c}, 0.0::DOUBLE) AS {f}" for c, f in N.ITEM_RATES.items())
    dense = ", ".join(f"{c} AS {f}" for c, f in N.ITEM_DENSE.items())
    return f"""SELECT p.clue_id, {sparse}, {rates}, {dense} FROM {priced} p
LEFT JOIN rates_0 r0 ON p.clue_id = r0.clue_id LEFT JOIN rates_1 r1 ON p.clue_id = r1.clue_id
LEFT JOIN rates_2 r2 ON p.clue_id = r2.clue_id WHERE {where}"""


SEQ_ATTRS = [a for a in N.SEQ_SPARSE if a != "clue_id"]

#: Tables of one snapshot that are stated once more for all days, with the day in front of their keys.
DAILY = ("acted", "items", "priced_snap", "action_cnt", "convert_cnt", "action_statis", "convert_statis",
         "action_ratio", "convert_ratio", "per_item", "rates_0", "users")


def daily_sql(sql: str) -> str:
    """A statement over one snapshot as one over all days: its keys are then 'day|key'."""
    return re.sub(rf"\b({'|'.join(DAILY)})\b", r"\1_days", sql)


def prices_days_sql(back: int) -> str:
    """The latest price of every item as of ``back`` days before each day."""
    return f"""
SELECT concat(day, '|', cast(clue_id AS INT)) AS clue_id, cast(model_price AS INT) AS model_price,
  cast(seller_price AS INT) AS seller_price, cast(car_level AS INT) AS car_level
FROM (SELECT *, row_number() OVER (PARTITION BY day, clue_id ORDER BY ts DESC, o DESC, l DESC, x DESC) AS rn
      FROM days JOIN price_log ON dt BETWEEN strftime(cast(day AS DATE) - {90 + back}, '%Y-%m-%d')
        AND strftime(cast(day AS DATE) - {back}, '%Y-%m-%d')) t
WHERE rn = 1"""


CTES = {
    "behaviour": """
SELECT cast(user_id AS VARCHAR) AS user_id, regexp_extract(props, '([0-9]+)', 1) AS clue_id,
  concat(user_id, '-', (day(ts) - 1) // 7) AS recommend_id, cast(day(ts) % 3 AS VARCHAR) AS page,
  CASE WHEN hour(ts) < 2 THEN 'SEARCH_INVITATION' WHEN hour(ts) < 5 THEN 'GRAB' ELSE 'SEARCH' END
    AS page_type,
  CASE event_type WHEN 'view' THEN 'beseen' WHEN 'click' THEN 'click'
    WHEN 'error' THEN 'quick_collection' WHEN 'purchase' THEN 'bid' ELSE 'order' END AS action,
  cast(cast(floor(value * 200) AS BIGINT) AS VARCHAR) AS amount,
  cast(cast(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts, strftime(ts, '%Y-%m-%d') AS dt
FROM events""",
    "orders_in": """
SELECT cast(user_id AS INT) AS user_id, cast(clue_id AS INT) AS clue_id,
  strftime(make_timestamp(cast(ts AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS create_time,
  cast(ts AS INT) AS ts, dt FROM behaviour WHERE action = 'order'""",
    "items": """
SELECT cast(p_partkey AS INT) AS clue_id, concat('F', p_partkey % 4) AS fuel_type,
  cast(p_partkey % 25 + 2000 AS VARCHAR) AS car_year, concat('G', p_partkey % 3) AS gearbox,
  concat('E', p_partkey % 6) AS emission_standard, p_brand AS tag_id,
  concat('C', p_partkey % 40) AS city_id, split_part(p_name, ' ', 1) AS car_color,
  concat('N', p_partkey % 5) AS guobie, split_part(p_name, ' ', 2) AS minor_category_id,
  p_type AS auto_type, p_size AS seats, cast(p_size * 1000 + p_partkey % 1000 AS INT) AS road_haul,
  CASE WHEN p_size <> 13 THEN p_size * 2 END AS evaluate_score,
  cast(floor(p_retailprice) AS INT) AS suggest_price,
  cast(p_partkey % 4 AS INT) AS transfer_num, cast(p_partkey % 20 + 2000 AS INT) AS license_year,
  cast(p_partkey % 12 + 1 AS INT) AS license_month, concat('L', p_partkey % 7) AS air_displacement,
  substr('ABCDE', cast(p_partkey % 5 + 1 AS INT), 1) AS evaluate_level,
  concat(p_partkey % 25 + 2000, '款 ', p_name) AS title, cast(p_partkey % 3 AS INT) AS sale_status,
  cast(p_partkey % 4 AS INT) AS auction_type,
  strftime(DATE '2023-11-01' + cast(p_partkey % 80 AS INT), '%Y-%m-%d') AS create_time FROM part""",
    "price_log": """
SELECT cast(l_partkey AS VARCHAR) AS clue_id,
  cast((cast(l_shipdate AS DATE) + 8110) - DATE '1970-01-01' AS INT) * 86400 AS ts,
  cast(cast(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS model_price,
  cast(cast(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) AS VARCHAR) AS seller_price,
  cast(l_linenumber AS VARCHAR) AS car_level,
  strftime(cast(l_shipdate AS DATE) + 8110, '%Y-%m-%d') AS dt, l_orderkey AS o, l_linenumber AS l,
  l_extendedprice AS x FROM lineitem""",
    "prices_run": prices_sql(RUN),
    "prices_snap": prices_sql(SNAP),
    "priced_run": priced_sql("prices_run"),
    "priced_snap": priced_sql("prices_snap"),
    "versions": ("SELECT * FROM (VALUES ('2024-06-04', 'old'), ('2024-11-01', 'new'))"
                 " v(dt, seed)"),
    "dictionary": dictionary_sql(),
    "codes": "SELECT fea_name, fea_val, encode_id FROM dictionary WHERE dt = '2024-11-01'",
    "code_maps": "SELECT fea_name, map(list(fea_val), list(encode_id)) AS m FROM codes GROUP BY fea_name",
    "acted": f"""
SELECT cast(user_id AS INT) AS user_id, action, cast(clue_id AS INT) AS clue_id,
  DATE '{SNAP}' - cast(dt AS DATE) AS age FROM behaviour WHERE dt <= '{SNAP}'""",
    "action_cnt": "SELECT user_id, action, " + ", ".join(
        f"cast(sum(CASE WHEN age BETWEEN {WINDOWS[w][0]} AND {WINDOWS[w][1]} THEN 1 ELSE 0 END) AS BIGINT) AS cnt_{w}"
        for w in ("0_7", "7_14", "14_30")) + " FROM acted WHERE action <> 'order' GROUP BY ALL",
    "convert_cnt": f"""
SELECT user_id, cast({cnt('order', '0_30')} AS BIGINT) AS cnt_0_30,
  cast({cnt('order', '0_365')} AS BIGINT) AS cnt_0_365
FROM acted WHERE action = 'order' GROUP BY user_id""",
    "action_statis": statis_sql("action IN ('click', 'bid')", {7: (0, 6), 30: (0, 29)}, "action"),
    "convert_statis": statis_sql("action = 'order'", {30: (0, 29), 365: (0, 364)},
                                 "'beseen' AS convert"),
    "action_ratio": ratio_sql("action IN ('click', 'bid')", ("0_7", "7_14", "14_30"), N.CLUSTERS,
                              "user_id, action"),
    "convert_ratio": ratio_sql("action = 'order'", ("0_30", "0_365"), N.ORDER_CLUSTERS, "user_id"),
    "per_item": _rates_sql("clue_id"),
    "per_tag": _rates_sql("tag_id"),
    "per_category": _rates_sql("minor_category_id"),
    "rates_0": "SELECT clue_id, " + ", ".join(
        ratio(f"{n}_{w}", f"{d}_{w}") + f" AS {d}_{n}_rate_{w}"
        for d, n in (("click", "bid"), ("beseen", "click")) for w in ("0_3", "0_30"))
        + " FROM per_item",
    "rates_1": "SELECT i.clue_id, " + ", ".join(
        ratio(f"t.bid_{w}", f"(SELECT sum(bid_{w}) FROM per_tag)")
        + f" AS tag_id_bid_percent_ratio_{w}" for w in ("0_7", "7_14", "14_30"))
        + " FROM items i JOIN per_tag t ON i.tag_id = t.tag_id",
    "rates_2": "SELECT i.clue_id, " + ", ".join(
        ratio(f"t.{n}_{w}", f"t.{d}_{w}") + f" AS tag_id_{n}_rate_{w}"
        for d, n in (("beseen", "click"), ("click", "bid")) for w in ("0_7", "7_14"))
        + ", CASE WHEN c.minor_category_id IS NOT NULL THEN "
        + ratio("c.click_0_7", "c.beseen_0_7") + " END AS minor_category_id_click_rate_0_7"
        " FROM items i JOIN per_tag t ON i.tag_id = t.tag_id"
        " LEFT JOIN per_category c ON i.minor_category_id = c.minor_category_id",
    "users": user_features_sql(),
    "refresh_users": f"""
SELECT c.*, k.cnt_0_30::DOUBLE AS d_u_contract_cnt_30, k.cnt_0_365::DOUBLE AS d_u_contract_cnt_365,
  s.* EXCLUDE (user_id), {', '.join('u.' + c for c in N.refresh_sparse())}
FROM (SELECT user_id, {', '.join(f"max(CASE WHEN action = '{a}' THEN {c} ELSE 0 END)::DOUBLE AS {n}"
                                 for n, (a, c) in N.refresh_count_columns().items())}
  FROM action_cnt GROUP BY user_id) c LEFT JOIN convert_cnt k ON c.user_id = k.user_id
LEFT JOIN (SELECT user_id, {', '.join(f"max(CASE WHEN action = '{a}' THEN {c} ELSE 0 END)::DOUBLE AS {n}"
                                      for n, (a, c) in N.refresh_stat_columns().items())}
  FROM action_statis GROUP BY user_id) s ON c.user_id = s.user_id
LEFT JOIN users u ON c.user_id = u.user_id""",
    # samples and impressions
    "scene": "SELECT * FROM behaviour WHERE page_type LIKE '%SEARCH%' AND page_type NOT LIKE '%INVITATION%'",
    "on_shelf": """
SELECT dt, cast(clue_id AS INT) AS clue_id, min(cast(ts AS INT)) AS on_sale_ts FROM scene
WHERE clue_id > '0' AND clue_id <> '' GROUP BY dt, cast(clue_id AS INT)""",
    "heads": """
SELECT dt, cast(user_id AS INT) AS user_id, recommend_id, page, min(cast(ts AS INT)) AS query_ts
FROM scene WHERE action = 'beseen' AND recommend_id <> '' AND user_id > '0' AND user_id <> ''
  AND clue_id > '0' AND clue_id <> '' GROUP BY ALL""",
    "numbered": f"""
SELECT *, row_number() OVER (PARTITION BY dt ORDER BY on_sale_ts, {draw('order', 'clue_id')}, clue_id) - 1 AS idx
FROM on_shelf""",
    "counted": """
SELECT h.dt, h.user_id, h.recommend_id, h.page, h.query_ts, count(i.clue_id) AS n
FROM heads h LEFT JOIN on_shelf i ON h.dt = i.dt AND h.query_ts > i.on_sale_ts GROUP BY ALL""",
    "picked": f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, recommend_id, page ORDER BY
  -ln({unit('1-user', 'dt', 'recommend_id', 'page', 'user_id')}) / greatest(n, 1), user_id) AS rn
  FROM counted) t
WHERE rn = 1 AND {unit('1-keep', 'dt', 'recommend_id', 'page', 'user_id')} <= 0.3""",
    "samples": f"""
SELECT DISTINCT dt, cast(user_id AS INT) AS user_id, cast(clue_id AS INT) AS clue_id, recommend_id,
  1 AS label, cast(ts AS INT) AS ts
FROM scene WHERE action = 'bid' AND recommend_id <> '' AND user_id > '0' AND user_id <> ''
  AND clue_id > '0' AND clue_id <> ''
UNION ALL
SELECT p.dt, p.user_id, i.clue_id, p.recommend_id, 0, p.query_ts FROM picked p
LEFT JOIN numbered i ON p.dt = i.dt AND p.n > 0
  AND i.idx = {draw('1-item', 'p.dt', 'p.recommend_id', 'p.page', 'p.user_id')} % nullif(p.n, 0)""",
    "day_samples": f"SELECT user_id, clue_id, recommend_id, label, ts, dt FROM samples WHERE dt = '{RUN}'",
    "label_events": """
SELECT * FROM (SELECT cast(clue_id AS INT) AS clue_id, cast(user_id AS INT) AS user_id,
  recommend_id, cast(amount AS INT) AS amount, cast(ts AS INT) AS ts, action, dt,
  row_number() OVER (PARTITION BY dt, clue_id, user_id, recommend_id, action
                     ORDER BY cast(ts AS INT), cast(amount AS INT)) AS rn
  FROM scene WHERE user_id <> '' AND user_id <> '0' AND user_id <> 'unknown' AND recommend_id <> ''
    AND clue_id <> '' AND action IN ('beseen', 'click', 'quick_collection', 'bid')) t WHERE rn = 1""",
    "prices_day": f"""
SELECT dt, clue_id, model_price FROM (SELECT e.dt, e.clue_id, cast(g.model_price AS INT) AS model_price,
  row_number() OVER (PARTITION BY e.dt, e.clue_id ORDER BY g.ts DESC, g.o DESC, g.l DESC, g.x DESC) AS rn
  FROM (SELECT DISTINCT dt, clue_id FROM label_events) e JOIN price_log g ON cast(g.clue_id AS INT) = e.clue_id
  AND g.dt BETWEEN strftime(cast(e.dt AS DATE) - {N.PRICE_DAYS}, '%Y-%m-%d') AND e.dt) t WHERE rn = 1""",
    "bids_priced": """
SELECT e.dt, e.clue_id, e.recommend_id, e.amount, p.model_price FROM label_events e
JOIN prices_day p ON e.dt = p.dt AND e.clue_id = p.clue_id WHERE e.action = 'bid' AND p.model_price > 0""",
    "impressions": """
SELECT a.dt, a.clue_id, a.user_id, a.recommend_id, a.ts, coalesce(is_click, 0) AS is_click,
  coalesce(is_quick_collection, 0) AS is_quick_collection, coalesce(is_bid, 0) AS is_bid,
  coalesce(is_daojia80, 0) AS is_daojia80, coalesce(is_daojia90, 0) AS is_daojia90,
  coalesce(is_daojia100, 0) AS is_daojia100, coalesce(is_order, 0) AS is_order
FROM (SELECT * FROM label_events WHERE action = 'beseen') a
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_click FROM label_events
  WHERE action = 'click') b USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_quick_collection FROM label_events
  WHERE action = 'quick_collection') c USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_bid FROM label_events
  WHERE action = 'bid') d USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_daojia80 FROM bids_priced
  WHERE amount > model_price * 0.8::DOUBLE) e USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_daojia90 FROM bids_priced
  WHERE amount > model_price * 0.9::DOUBLE) f USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT dt, clue_id, recommend_id, 1 AS is_daojia100 FROM bids_priced
  WHERE amount > model_price) g USING (dt, clue_id, recommend_id)
LEFT JOIN (SELECT DISTINCT i.dt, o.clue_id, o.user_id, 1 AS is_order
  FROM orders_in o JOIN (SELECT DISTINCT dt FROM behaviour) i
  ON substr(o.create_time, 1, 10) BETWEEN i.dt
     AND strftime(cast(i.dt AS DATE) + 3, '%Y-%m-%d')) h
  ON a.dt = h.dt AND a.clue_id = h.clue_id AND a.user_id = h.user_id""",
    "clicks": """
SELECT cast(user_id AS INT) AS user_id, cast(clue_id AS INT) AS clue_id, cast(ts AS INT) AS ts
FROM behaviour WHERE action = 'click'""",
    "item_table": item_table_sql("priced_run"),
    "seq_items": "SELECT clue_id, " + ", ".join(
        code_of(a, N.SEQ_DICTIONARY.get(a, a)) + f" AS {a}" for a in SEQ_ATTRS)
        + ", " + ", ".join(N.SEQ_DENSE) + " FROM priced_run",
    # the last ten clicks before each impression
    "click_hist": """
SELECT m.user_id, m.ts, e.clue_id, row_number() OVER (PARTITION BY m.user_id, m.ts
  ORDER BY e.ts DESC, e.clue_id DESC) AS rn
FROM (SELECT DISTINCT user_id, ts FROM impressions) m JOIN clicks e
ON m.user_id = e.user_id AND m.ts > e.ts + 60""",
    "click_seqs": """
SELECT h.user_id, h.ts, list(i.clue_id ORDER BY rn) AS clues, list(i.tag_id ORDER BY rn) AS tags,
  list(i.road_haul ORDER BY rn) AS hauls, list(i.seller_price ORDER BY rn) AS sellers
FROM click_hist h JOIN seq_items i ON h.clue_id = i.clue_id WHERE rn <= 10 GROUP BY ALL""",
    "features": """
SELECT m.user_id, m.clue_id, m.recommend_id, m.is_bid AS label, m.ts, u.s_u_click_tag_id_0_7,
  u.d_u_click_cnt_0_7, u.d_u_click_road_haul_max_0_7, i.s_i_tag_id, i.s_i_city_id,
  i.d_i_c2b_evaluate_score, i.d_i_c2b_ctob_model_price, i.d_i_road_haul,
  list_concat(s.clues, list_resize([]::INT[], 10 - coalesce(len(s.clues), 0), 1)) AS clues,
  list_concat(s.tags, list_resize([]::INT[], 10 - coalesce(len(s.tags), 0), 1)) AS tags,
  list_filter(s.hauls, lambda x: x IS NOT NULL) AS hauls,
  list_filter(s.sellers, lambda x: x IS NOT NULL) AS sellers, m.dt
FROM impressions m LEFT JOIN users u ON m.user_id = u.user_id
LEFT JOIN item_table i ON m.clue_id = i.clue_id
LEFT JOIN click_seqs s ON m.user_id = s.user_id AND m.ts = s.ts""",
    # vectors
    "old_vectors": """
SELECT vec_id, list_concat([embedding[1]::DOUBLE + CASE WHEN label < 3 THEN 0.5::DOUBLE
  ELSE 1e-9::DOUBLE END], embedding[2:]::DOUBLE[]) AS embedding FROM embeddings WHERE label <> 9""",
    "pair_scores": """
SELECT m.dt, m.user_id, m.clue_id, m.recommend_id, m.is_bid AS label, m.ts,
  list_dot_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[]) AS inner_product
FROM impressions m JOIN embeddings u ON m.user_id = u.vec_id
JOIN embeddings i ON m.clue_id = i.vec_id""",
    "scored": """
SELECT dt, user_id, clue_id, recommend_id, label, ts, inner_product,
  round(1 / (1 + exp(-inner_product)), 2) AS score FROM pair_scores""",
}


CTES |= {
    "days": "SELECT DISTINCT dt AS day FROM behaviour",
    "acted_days": """
SELECT concat(day, '|', cast(user_id AS INT)) AS user_id, action, concat(day, '|', cast(clue_id AS INT)) AS clue_id,
  cast(day AS DATE) - 1 - cast(dt AS DATE) AS age FROM behaviour JOIN days ON dt < day""",
    "items_days": "SELECT * REPLACE (concat(day, '|', clue_id) AS clue_id) FROM items, days",
    "prices_days": prices_days_sql(0),
    "prices_before": prices_days_sql(1),
    "priced_days": daily_sql(priced_sql("prices_days")),
    "priced_snap_days": daily_sql(priced_sql("prices_before")),
    **{f"{n}_days": daily_sql(CTES[n]) for n in DAILY[3:]},
    "seq_items_days": CTES["seq_items"].replace("priced_run", "priced_days"),
}


def with_tables(sql: str) -> str:
    """Put the tables that ``sql`` names, and those they name, in front of it."""
    def named(text):
        return {n for n in CTES if re.search(rf"\b{n}\b", text)}

    need, todo = set(), named(sql)
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo |= named(CTES[n]) - {n}
    if not need:
        return sql.strip()
    body = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in CTES if n in need)
    sql = sql.strip()
    if sql.startswith("WITH "):
        return f"WITH {body},\n{sql[5:]}"
    return f"WITH {body}\n{sql}"
