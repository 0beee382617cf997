"""Whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.fixtures import MIN_CREATE, RUN, SNAP
from checks.q_evaluation import SPEC, TOTALS, tower_sql, tower_weights, vector_totals
from checks.q_operators import DENSE, ORDERED, SEQS
from checks.registry import digits, digits_sql, query
from checks.tables_sql import code_of, item_table_sql
from paddock.operators.filters import feature_families
from paddock.operators.sequences import last_items
from paddock.operators.towers import TowerSpec, tower_forward
from paddock.plans import names as N
from paddock.plans import preprocess as PP
from paddock.plans import refresh as RF
from paddock.plans.daily import backfill, daily_samples, range_sequences
from paddock.plans.evaluation import evaluate
from paddock.plans.items import item_features
from paddock.plans.samples import impression_labels, test_samples, train_samples
from paddock.plans.users import sample_user_features
from paddock.session import shared_dir
from paddock.sources.models import pack_weights
from paddock.sources.versions import write_version

FLAG = "coalesce(array_to_string(list_concat({c}, list_resize([]::INT[], 10 - coalesce(len({c}), 0), 1)), ','), '')"


@query("entry_last_clicked_items", f"""
SELECT m.user_id, m.ts, {FLAG.format(c='s.clues')} AS clue_id, {FLAG.format(c='s.tags')} AS tag_id
FROM (SELECT DISTINCT user_id, ts FROM impressions) m
JOIN click_seqs s ON m.user_id = s.user_id AND m.ts = s.ts""")
def _(t):
    """Scene, ids, visibility lag, last ten, item join, ordered arrays, padding."""
    out = last_items(t.impressions, t.clicks, t.sequence_items, ["clue_id", "tag_id"], pad="1")
    return out.select("user_id", "ts", *[F.concat_ws(",", c).alias(c) for c in ("clue_id", "tag_id")])


@query("p1_train_samples", "SELECT dt, user_id, clue_id, recommend_id, label, ts FROM samples")
def _(t):
    return train_samples(t.behaviour)


@query("p2_impression_labels", "SELECT * FROM impressions")
def _(t):
    return impression_labels(t.behaviour, t.day_prices, t.orders)


@query("p3_test_samples", """
SELECT dt, user_id, clue_id, recommend_id, is_bid AS label, ts FROM impressions""")
def _(t):
    return test_samples(impression_labels(t.behaviour, t.day_prices, t.orders))


@query("p4_user_offline_features", "SELECT * FROM users")
def _(t):
    return t.user_features(SNAP)


RATE_NAMES = list(N.ITEM_RATES.values())
ITEM_NAMES = [f for _, f, _ in N.ITEM_SPARSE]


def item_cols(alias):
    sparse = ", ".join(f"coalesce({alias}.{f}, 1) AS {f}" for f in ITEM_NAMES)
    rates = ", ".join(f"round({alias}.{f}, 6) AS {f}" for f in RATE_NAMES)
    return f"{sparse}, {rates}, {', '.join(f'{alias}.{f}' for f in N.ITEM_DENSE.values())}"


RECENT_TABLE = f"({item_table_sql('priced_run', chr(39) + '2023' + chr(39) + ' < create_time')})"


def rounded(df, cols):
    cols = set(cols)
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("p5_item_features", f"""
SELECT s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, {item_cols('i')}
FROM samples s LEFT JOIN {RECENT_TABLE} i ON s.clue_id = i.clue_id WHERE s.clue_id IS NOT NULL""")
def _(t):
    out = item_features(t.samples.drop("dt"), t.items, t.prices(RUN), t.rates(SNAP), t.codes, RUN, MIN_CREATE)
    return rounded(out, RATE_NAMES)


USER_COLS = [
    "d_u_beseen_cnt_0_7", *list(N.action_count_columns())[1:],
    "d_u_contract_cnt_30", "d_u_contract_cnt_365", *N.action_stat_columns(),
    *N.order_stat_columns(), *N.action_favourites(), *N.order_favourites("0_30"),
    *N.order_favourites("0_365")]


@query("p6_sample_user_features", f"""
SELECT s.dt, s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, {', '.join(USER_COLS)}
FROM samples s LEFT JOIN users u ON s.user_id = u.user_id""")
def _(t):
    return sample_user_features(t.samples, t.users(SNAP))


def _events_sql(action):
    if action == "contract":
        return "SELECT user_id, clue_id, ts, substr(create_time, 1, 10) AS at FROM orders_in"
    return (f"SELECT cast(user_id AS INT) AS user_id, cast(clue_id AS INT) AS clue_id, "
            f"cast(ts AS INT) AS ts, dt AS at FROM behaviour WHERE action = '{action}'")


def _sequence_sql(action, spine, items="seq_items"):
    """Sequences of one action: the last ten events that each moment of ``spine`` can see
    of the days its own day's job looks at.  ``items`` may hold the items of each day."""
    back, until = (90, 1) if action == "contract" else (29, 0)
    item = "concat(h.dt, '|', h.clue_id)" if items == "seq_items_days" else "h.clue_id"
    cols = [f"list(i.{a} ORDER BY rn) AS {N.seq_name('s', action, n)}"
            for a, n in N.SEQ_SPARSE.items() if a != "clue_id"]
    cols.append(f"list(h.clue_id ORDER BY rn) AS {N.seq_name('s', action, 'clue_id')}")
    cols += [f"list(i.{a} ORDER BY rn) AS {N.seq_name('d', action, n)}"
             for a, n in N.SEQ_DENSE.items()]
    if action == "click":
        for m, name in N.REALTIME.items():
            cols += [f"round(avg({m}), 6) AS {name.format(stat='avg')}",
                     f"max({m}) AS {name.format(stat='max')}",
                     f"min({m}) AS {name.format(stat='min')}",
                     f"quantile_disc({m}, 0.5) AS {name.format(stat='p50')}"]
    return f"""
SELECT h.user_id, h.ts, {', '.join(cols)} FROM (SELECT m.user_id, m.ts, m.dt, e.clue_id,
  row_number() OVER (PARTITION BY m.user_id, m.ts ORDER BY e.ts DESC, e.clue_id DESC) AS rn
  FROM (SELECT DISTINCT user_id, ts, dt FROM {spine}) m JOIN ({_events_sql(action)}) e
  ON m.user_id = e.user_id AND m.ts > e.ts + 60
  AND e.at BETWEEN strftime(cast(m.dt AS DATE) - {back}, '%Y-%m-%d')
    AND strftime(cast(m.dt AS DATE) - {until}, '%Y-%m-%d')) h
JOIN {items} i ON {item} = i.clue_id WHERE rn <= 10 GROUP BY h.user_id, h.ts"""


def _seq_out():
    out = []
    for alias, a in zip("bcd", N.SEQ_ACTIONS):
        for n in N.SEQ_SPARSE.values():
            c = N.seq_name("s", a, n)
            out.append(f"array_to_string(list_concat({alias}.{c}, list_resize([]::INT[], "
                       f"10 - coalesce(len({alias}.{c}), 0), 1)), ',') AS {c}")
        for n in N.SEQ_DENSE.values():
            c = N.seq_name("d", a, n)
            out.append(f"coalesce(array_to_string({alias}.{c}, ','), '') AS {c}")
    stats = [name.format(stat=s) for name in N.REALTIME.values() for s in ("avg", "max", "min", "p50")]
    return ", ".join(out + [f"b.{c}" for c in stats])


def _seq_joins(spine, items="seq_items"):
    return " ".join(
        f"LEFT JOIN ({_sequence_sql(a, spine, items)}) {x} ON s.user_id = {x}.user_id AND s.ts = {x}.ts"
        for x, a in zip("bcd", N.SEQ_ACTIONS))


AVG_NAMES = [name.format(stat="avg") for name in N.REALTIME.values()]


@query("p7_sample_sequences", f"""
SELECT s.dt, s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, {_seq_out()}
FROM samples s {_seq_joins('samples', 'seq_items_days')}""")
def _(t):
    """All samples of all days, each with the history and the items of its own day."""
    return rounded(range_sequences(t.inputs, t.samples, *t.log_days, as_text=True), AVG_NAMES)


@query("p8_daily_samples", f"""
SELECT s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, {item_cols('i')}, {', '.join(USER_COLS)},
  {_seq_out()}, '{RUN}' AS dt
FROM day_samples s LEFT JOIN {RECENT_TABLE} i ON s.clue_id = i.clue_id
LEFT JOIN users u ON s.user_id = u.user_id {_seq_joins('day_samples')}
WHERE s.clue_id IS NOT NULL""")
def _(t):
    return rounded(daily_samples(t.inputs, RUN, as_text=True), RATE_NAMES + AVG_NAMES)


def _model_inputs_sql(local=False):
    """Filled and standardized columns; short sequences padded with the median of all or their own."""
    def own(s):
        return f"CASE WHEN len({s}) > 0 THEN list_median({s}::DOUBLE[]) ELSE m_{s} END"

    fit, out = [], []
    for c in DENSE:
        fit.append(f"(SELECT median({c}) FROM features) AS m_{c}")
    for s in SEQS.values():
        fit.append(f"(SELECT median(y)::DOUBLE FROM (SELECT unnest({s}) AS y FROM features) q) AS m_{s}")
    pads = ", ".join(
        f"list_concat(coalesce({s}, [])::DOUBLE[], list_resize([]::DOUBLE[], "
        f"10 - coalesce(len({s}), 0), {own(s) if local else f'm_{s}'})) AS p_{s}" for s in SEQS.values())
    fills = ", ".join(f"coalesce({c}, m_{c})::DOUBLE AS v_{c}" for c in DENSE)
    dev = ", ".join(f"avg(v_{c}) AS a_{c}, CASE WHEN stddev_pop(v_{c}) = 0 THEN 1 ELSE "
                    f"stddev_pop(v_{c}) END AS d_{c}" for c in DENSE)
    seqdev = ", ".join(
        f"(SELECT avg(x) FROM (SELECT unnest(p_{s}) AS x FROM filled) q) AS a_{s}, "
        f"(SELECT stddev_pop(x) FROM (SELECT unnest(p_{s}) AS x FROM filled) q) AS d_{s}"
        for s in SEQS.values())
    out += [f"round((v_{c} - a_{c}) / d_{c}, 5) AS {c}" for c in DENSE]
    for name, s in SEQS.items():
        out.append(digits_sql(f"list_transform(p_{s}, lambda x: (x - a_{s}) / d_{s})") + f" AS {name}")
        out.append(f"cast(len(p_{s}) AS INT) AS {name}_n")
    tables = f"""
WITH medians AS (SELECT {', '.join(fit)}),
filled AS (SELECT f.*, {fills}, {pads} FROM features f, medians),
scalers AS (SELECT *, {seqdev} FROM (SELECT {dev} FROM filled) d)"""
    return tables, f"""
SELECT user_id AS original_user_id, cast(user_id % 8001 AS INT) AS user_id, clue_id, recommend_id,
  label, ts, coalesce(s_u_click_tag_id_0_7, 1) AS s_u_click_tag_id_0_7,
  coalesce(s_i_tag_id, 1) AS s_i_tag_id, coalesce(s_i_city_id, 1) AS s_i_city_id,
  concat('[', array_to_string(tags, ','), ']') AS s_seq_c2b_click_tag_id_seq, {', '.join(out)}, dt
FROM filled, scalers"""


FITTED, PREPARED = _model_inputs_sql()
MODEL_INPUTS = FITTED + PREPARED


def summed(df):
    """Standardized columns to 5 digits, the elements of JSON sequences to 4."""
    out = []
    for c in df.columns:
        if c in DENSE:
            out.append(F.round(c, 5).alias(c))
        elif c in SEQS:
            v = F.from_json(c, "array<double>")
            out += [digits(v).alias(c), F.size(v).alias(f"{c}_n")]
        elif c != "s_seq_c2b_click_clue_id_seq":
            out.append(F.col(c))
    return df.select(*out)


@query("p9_preprocess_fit", MODEL_INPUTS)
def _(t):
    return summed(PP.preprocess_fit(t.features)[0])


@query("p9_preprocess_local", "".join(_model_inputs_sql(local=True)))
def _(t):
    """Short sequences are padded with their own median."""
    return summed(PP.preprocess_fit(t.features, local=True)[0])


def _tower_inputs_sql():
    """The prepared rows as inputs of the user tower, sequences as lists."""
    dense = ", ".join(f"(v_{c} - a_{c}) / d_{c} AS {c}" for c in SPEC.dense)
    seqs = ", ".join(f"list_transform(p_{s}, lambda x: (x - a_{s}) / d_{s}) AS {name}"
                     for name, s in SEQS.items() if name in SPEC.dense_seq)
    return f"""{FITTED}, inputs AS (SELECT user_id AS original_user_id, clue_id, ts, cast(user_id % 8001 AS INT) AS user_id,
  coalesce(s_u_click_tag_id_0_7, 1) AS s_u_click_tag_id_0_7, tags AS s_seq_c2b_click_tag_id_seq, {dense}, {seqs}
  FROM filled, scalers),
{tower_sql(SPEC, 'inputs')}
SELECT original_user_id, {TOTALS}, n FROM tower"""


@query("m5_tower_forward", _tower_inputs_sql())
def _(t):
    """User vectors of all preprocessed rows."""
    ready = PP.preprocess_fit(t.features, as_json=False)[0]
    out = tower_forward(ready, tower_weights(t.spark, SPEC), SPEC, "original_user_id")
    return out.select("original_user_id", *vector_totals("embedding"))


@query("p10_preprocess_apply", MODEL_INPUTS)
def _(t):
    """Statistics saved, loaded and applied to the same rows give the same inputs."""
    from paddock.sources import load_stats, save_stats

    families = feature_families(t.features)
    path = f"{shared_dir(t.spark)}/stats-{uuid.uuid4().hex[:12]}"
    save_stats(PP.fit(PP.prepare(t.features, families), families), path)
    return summed(PP.preprocess_apply(t.features, load_stats(t.spark, path)))


RAW = """
SELECT m.user_id, m.clue_id, m.ts, coalesce(a.encode_id, 1) AS s_i_tag_id,
  coalesce(b.encode_id, 1) AS s_i_city_id,
  concat('[', coalesce(q.cities || ',', ''), array_to_string(list_resize([]::INT[],
    10 - coalesce(q.n, 0), 1), ','), ']') AS s_seq_c2b_click_city_id_seq
FROM impressions m LEFT JOIN items i ON m.clue_id = i.clue_id
LEFT JOIN codes a ON a.fea_name = 'tag_id' AND a.fea_val = i.tag_id
LEFT JOIN codes b ON b.fea_name = 'city_id' AND b.fea_val = i.city_id
LEFT JOIN (SELECT user_id, ts, count(*) AS n,
  string_agg(cast(coalesce(c.encode_id, 1) AS VARCHAR), ',' ORDER BY rn) AS cities
  FROM click_hist h JOIN items j ON h.clue_id = j.clue_id
  LEFT JOIN codes c ON c.fea_name = 'city_id' AND c.fea_val = j.city_id
  WHERE rn <= 10 GROUP BY ALL) q ON m.user_id = q.user_id AND m.ts = q.ts"""


@query("p11_preprocess_raw", RAW.replace("|| ',', ''", "|| CASE WHEN q.n < 10 THEN ',' ELSE '' END, ''"))
def _(t):
    """Raw categories and raw sequences through dictionary, padding and fit."""
    from paddock.operators.joins import lookup_join

    items = t.items.select("clue_id", F.col("tag_id").alias("s_i_tag_id"),
                           F.col("city_id").alias("s_i_city_id"),
                           F.col("road_haul").alias("d_i_road_haul"))
    seqs = last_items(t.impressions, t.clicks, t.items, ["city_id"])
    seqs = seqs.select("user_id", "ts", F.concat_ws(",", "city_id").alias("s_seq_c2b_click_city_id_seq"))
    rows = t.impressions.select("user_id", "clue_id", "recommend_id",
                                F.col("is_bid").alias("label"), "ts", "dt")
    rows = lookup_join(lookup_join(rows, items, "clue_id"), seqs, ["user_id", "ts"])
    rows = rows.select("user_id", "clue_id", "recommend_id", "label", "ts", "s_i_tag_id",
                       "s_i_city_id", "d_i_road_haul", "s_seq_c2b_click_city_id_seq", "dt")
    out = PP.preprocess_raw(rows, t.codes)[0]
    return out.select(F.col("original_user_id").alias("user_id"), "clue_id", "ts", "s_i_tag_id",
                      "s_i_city_id", "s_seq_c2b_click_city_id_seq")


USER_SPEC = TowerSpec(
    sparse={**{c: f"emb_{a}" for c, a in N.refresh_sparse().items()}, "user_bucket": "emb_user"},
    dense=N.refresh_dense())
ITEM_SPEC = TowerSpec(
    sparse={"s_i_tag_id": "emb_tag_id", "s_i_seats": "emb_seats"},
    dense=["d_i_road_haul", "d_i_c2b_evaluate_score", "d_i_c2b_ctob_model_price"])


def fitted(df, cols):
    families = {"d_u": list(cols), "d_i": [], "d_seq": []}
    return PP.fit(df, families)


def scaled_sql(table, dense):
    """Statistics of columns of a table and, by ``ready``, a column under them."""
    fit = ", ".join(f"median({c})::DOUBLE AS m_{c}" for c in dense)
    dev = ", ".join(f"avg(coalesce({c}, m_{c})) AS a_{c}, CASE WHEN stddev_pop(coalesce({c}, m_{c})) = 0 THEN 1 "
                    f"ELSE stddev_pop(coalesce({c}, m_{c})) END AS d_{c}" for c in dense)
    return (f"mid AS (SELECT {fit} FROM {table}), "
            f"dev AS (SELECT {', '.join(f'any_value(m_{c}) AS m_{c}' for c in dense)}, {dev} FROM {table}, mid)")


def ready(c):
    return f"(coalesce({c}, m_{c})::DOUBLE - a_{c}) / d_{c}"


VECTOR = f"n, {TOTALS}"


@query("p12_refresh_user_vectors", f"""
WITH {scaled_sql('refresh_users', USER_SPEC.dense)}, active AS (SELECT DISTINCT cast(user_id AS INT) AS user_id FROM behaviour
  WHERE dt BETWEEN strftime(DATE '{RUN}' - 7, '%Y-%m-%d') AND '{RUN}' AND action = 'beseen'
    AND (page_type LIKE '%SEARCH%' OR page_type LIKE '%GRAB%') AND user_id <> ''),
before AS (SELECT DISTINCT cast(user_id AS INT) AS user_id FROM behaviour
  WHERE dt BETWEEN strftime(DATE '{SNAP}' - 7, '%Y-%m-%d') AND '{SNAP}' AND action = 'beseen'
    AND (page_type LIKE '%SEARCH%' OR page_type LIKE '%GRAB%') AND user_id <> ''),
written AS (SELECT user_id, '{SNAP}' AS run FROM before
  UNION ALL SELECT user_id, '{RUN}' FROM active WHERE user_id NOT IN (SELECT user_id FROM before)),
inputs AS (SELECT a.user_id, a.run, {', '.join(f'coalesce({c}, 1) AS {c}' for c in N.refresh_sparse())},
  a.user_id % 8001 AS user_bucket,
  {', '.join(f'{ready(c)} AS {c}' for c in USER_SPEC.dense)}
  FROM written a LEFT JOIN refresh_users u ON a.user_id = u.user_id, dev),
{tower_sql(USER_SPEC, 'inputs')}
SELECT run, concat('user_vector:', user_id) AS key, 604800 AS ttl, {VECTOR} FROM tower""")
def _(t):
    """A first run writes all users, a second one with the same features those who became active only.

    All inputs of the model: 32 dense, 50 favourite categories and the user.
    """
    features = t.refresh_users(SNAP)
    weights = pack_weights(tower_weights(t.spark, USER_SPEC))
    stats = fitted(features, USER_SPEC.dense)
    store = f"{shared_dir(t.spark)}/user-vectors-{uuid.uuid4().hex[:12]}"
    runs = [RF.refresh_user_vectors(t.behaviour, features, stats, weights, USER_SPEC, store, day)[2].select(
        F.lit(day).alias("run"), "key", "ttl", F.from_json("value", "array<float>").alias("v")) for day in (SNAP, RUN)]
    return runs[0].unionByName(runs[1]).select("run", "key", "ttl", *vector_totals("v"))


@query("p13_refresh_item_vectors", f"""
WITH {scaled_sql('item_table', ITEM_SPEC.dense)},
inputs AS (SELECT clue_id, coalesce(s_i_tag_id, 1) AS s_i_tag_id, coalesce(s_i_seats, 1) AS s_i_seats,
  {', '.join(f'{ready(c)} AS {c}' for c in ITEM_SPEC.dense)} FROM item_table, dev),
{tower_sql(ITEM_SPEC, 'inputs')}
SELECT i.clue_id, 'v1' AS model_version, {VECTOR}, CASE WHEN create_time > '2023-12-01' THEN 'new'
  ELSE 'existing' END AS reason FROM items i JOIN tower t ON i.clue_id = t.clue_id
WHERE sale_status = 0 AND auction_type IN (1, 2)""")
def _(t):
    """Vectors of the items on sale; those created up to December were known before."""
    weights = pack_weights(tower_weights(t.spark, ITEM_SPEC))
    table = t.stored("item_table", lambda: _item_table(t))
    stats = fitted(table, ITEM_SPEC.dense)
    store = f"{shared_dir(t.spark)}/item-vectors-{uuid.uuid4().hex[:12]}"
    old = t.items.where("create_time <= '2023-12-01'").select(
        "clue_id", F.array(F.lit(0.0).cast("float")).alias("embedding"))
    write_version(old, store, "before")
    _, todo, payload = RF.refresh_item_vectors(
        t.items, t.prices(RUN), t.rates(SNAP), t.codes, stats, weights, ITEM_SPEC, store, RUN, "v1")
    out = payload.join(todo.select("clue_id", "reason"), "clue_id")
    return out.withColumn("v", F.from_json("embedding", "array<float>")).select(
        "clue_id", "model_version", *vector_totals("v"), "reason")


def _item_table(t):
    from paddock.plans.items import item_table

    return item_table(t.items, t.prices(RUN), t.rates(SNAP), t.codes, RUN)


@query("p14_evaluate", f"""
WITH parts AS (SELECT o.split, o.is_bid AS label, o.recommend_id,
  1 / (1 + exp(-list_dot_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[]))) AS score
  FROM ({ORDERED}) o JOIN embeddings u ON o.user_id = u.vec_id JOIN embeddings i ON o.clue_id = i.vec_id),
ranked AS (SELECT *, rank() OVER (PARTITION BY split ORDER BY score)
    + (count(*) OVER (PARTITION BY split, score) - 1) / 2.0::DOUBLE AS rk,
  rank() OVER (PARTITION BY split, recommend_id ORDER BY score)
    + (count(*) OVER (PARTITION BY split, recommend_id, score) - 1) / 2.0::DOUBLE AS gk FROM parts),
grouped AS (SELECT split, recommend_id, count(*) AS n, (sum(CASE WHEN label = 1 THEN gk END)
    - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (sum(label) * (count(*) - sum(label))) AS auc
  FROM ranked GROUP BY ALL HAVING sum(label) > 0 AND sum(label) < count(*))
SELECT r.split, count(*) AS rows, cast(sum(label) AS BIGINT) AS positives,
  round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
    / (sum(label) * (count(*) - sum(label))), 4) AS auc, any_value(g.gauc) AS gauc,
  round(avg(CASE WHEN (score > 0.5)::INT = label THEN 1 ELSE 0 END), 3) AS accuracy
FROM ranked r LEFT JOIN (SELECT split, round(sum(auc * n) / sum(n), 4) AS gauc FROM grouped
  GROUP BY split) g ON r.split = g.split GROUP BY r.split""")
def _(t):
    users = t.vectors.select(F.col("vec_id").cast("int").alias("user_id"),
                             F.col("embedding").alias("user_embedding"))
    items = t.vectors.select(F.col("vec_id").cast("int").alias("clue_id"),
                             F.col("embedding").alias("item_embedding"))
    return evaluate(test_samples(t.impressions), users, items)


#: The item rates of the backfill's SQL: those of an item itself.
OWN_RATES = [c for c in N.ITEM_RATES if c.split("_")[0] in ("click", "beseen")]


def item_days_sql():
    sparse = ", ".join(f"{code_of('p.' + a, d)} AS {f}" for a, f, d in N.ITEM_SPARSE)
    rates = ", ".join(f"coalesce({c}, 0.0::DOUBLE) AS {N.ITEM_RATES[c]}" for c in OWN_RATES)
    dense = ", ".join(f"{c} AS {f}" for c, f in N.ITEM_DENSE.items())
    return (f"SELECT p.clue_id, {sparse}, {rates}, {dense} FROM priced_days p "
            "LEFT JOIN rates_0_days r ON p.clue_id = r.clue_id WHERE '2023' < create_time")


def backfill_sql():
    sparse = ", ".join(f"coalesce(i.{f}, 1) AS {f}" for f in ITEM_NAMES)
    rates = ", ".join(f"round(i.{N.ITEM_RATES[c]}, 6) AS {N.ITEM_RATES[c]}" for c in OWN_RATES)
    return f"""
SELECT s.user_id, s.clue_id, s.recommend_id, s.label, s.ts, {sparse}, {rates},
  {', '.join(f'i.{f}' for f in N.ITEM_DENSE.values())}, {', '.join(USER_COLS)}, {_seq_out()},
  s.dt, 'SEARCH' AS scene
FROM samples s LEFT JOIN ({item_days_sql()}) i ON concat(s.dt, '|', s.clue_id) = i.clue_id
LEFT JOIN users_days u ON concat(s.dt, '|', s.user_id) = u.user_id
{_seq_joins('samples', 'seq_items_days')} WHERE s.clue_id IS NOT NULL"""


@query("p15_backfill", backfill_sql())
def _(t):
    """All days of the log by one job: every feature of every sample as its own day's job has it."""
    path = f"{shared_dir(t.spark)}/backfill-{uuid.uuid4().hex[:12]}"
    backfill(t.inputs, *t.log_days, path, as_text=True)
    back = t.spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))
    shared = [N.ITEM_RATES[c] for c in N.ITEM_RATES if c not in OWN_RATES]
    return rounded(back.drop(*shared), [N.ITEM_RATES[c] for c in OWN_RATES] + AVG_NAMES)
