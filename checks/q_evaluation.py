"""Scoring and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import RUN
from checks.registry import query
from paddock.operators import compare as C
from paddock.operators import evaluate as M
from paddock.operators.retrieval import recall_at_n, top_items
from paddock.operators.towers import HIDDEN, DENSE_WIDTH, VECTOR, TowerSpec

PER = """
SELECT {by} count(*) AS rows, cast(sum(label) AS BIGINT) AS positives,
  CASE WHEN sum(label) > 0 AND sum(label) < count(*) THEN
    (sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
    / (sum(label) * (count(*) - sum(label))) END AS auc
FROM (SELECT *, rank() OVER (PARTITION BY {part} ORDER BY score)
  + (count(*) OVER (PARTITION BY {part}, score) - 1) / 2.0::DOUBLE AS rk FROM scored) s {group}"""


def per(*by):
    cols = ", ".join(by)
    return PER.format(by=cols + "," if by else "", part=cols or "1",
                      group=f"GROUP BY {cols}" if by else "")


@query("m1_auc", f"SELECT rows, positives, round(auc, 6) AS auc FROM ({per()}) a")
def _(t):
    return M.auc(t.scored).withColumn("auc", F.round("auc", 6))


@query("m1_group_auc", f"""
SELECT recommend_id, rows, positives, round(auc, 6) AS auc FROM ({per('recommend_id')}) a""")
def _(t):
    return M.group_auc(t.scored, "recommend_id").withColumn("auc", F.round("auc", 6))


@query("m2_gauc", f"""
SELECT count(*) AS groups, round(sum(auc * rows) / sum(rows), 4) AS gauc
FROM ({per('recommend_id')}) a WHERE auc IS NOT NULL""")
def _(t):
    return M.gauc(t.scored)


@query("m3_accuracy", """
SELECT round(avg(CASE WHEN (score > 0.5)::INT = label THEN 1 ELSE 0 END), 3) AS accuracy FROM scored""")
def _(t):
    return M.accuracy(t.scored)


@query("m4_score_pairs", """
SELECT dt, user_id, clue_id, recommend_id, label, ts, round(inner_product, 6) AS inner_product,
  round(1 / (1 + exp(-inner_product)), 6) AS score FROM pair_scores""")
def _(t):
    users = t.vectors.select(F.col("vec_id").cast("int").alias("user_id"),
                             F.col("embedding").alias("user_embedding"))
    items = t.vectors.select(F.col("vec_id").cast("int").alias("clue_id"),
                             F.col("embedding").alias("item_embedding"))
    pairs = t.impressions.select("dt", "user_id", "clue_id", "recommend_id",
                                 F.col("is_bid").alias("label"), "ts")
    out = M.score_pairs(users, items, pairs)
    return out.withColumns({c: F.round(c, 6) for c in ("inner_product", "score")})


def tower_shapes(spec: TowerSpec, vocab: int = 64, dim: int = 6, buckets: int = 8001) -> dict:
    """(rows, columns) of every layer of a model for ``spec``."""
    shapes = {}
    for layer in list(spec.sparse.values()) + list(spec.sparse_seq.values()):
        shapes[layer] = (buckets if layer == "emb_user" else vocab, dim)
    width = dim * (len(spec.sparse) + len(spec.sparse_seq))
    if spec.dense:
        shapes["dense"] = (len(spec.dense), DENSE_WIDTH)
        width += DENSE_WIDTH
    if spec.dense_seq:
        shapes["dense_seq"] = (10 * len(spec.dense_seq), DENSE_WIDTH)
        width += DENSE_WIDTH
    for i, h in enumerate(HIDDEN):
        shapes[f"hidden_{i}"], width = (width, h), h
    shapes["vector"] = (width, VECTOR)
    return shapes


def tower_weights(spark, spec: TowerSpec):
    """Weights from a formula, as a table; the rows of a model of this shape."""
    parts = None
    for i, (layer, (r, c)) in enumerate(sorted(tower_shapes(spec).items())):
        cells = spark.range(r * c).select(
            F.lit(layer).alias("layer"), F.floor(F.col("id") / c).cast("int").alias("row"),
            (F.col("id") % c).cast("int").alias("col"),
            (((F.col("id") * 7919 + i * 31) % 1000) / 5000.0 - 0.1).alias("value"))
        parts = cells if parts is None else parts.unionByName(cells)
    return parts


def tower_sql(spec: TowerSpec, inputs: str) -> str:
    """Tables ``tower``: the rows of ``inputs`` with n and the totals of their vector.

    Layers are lists of their columns, embeddings lists of their rows.
    """
    shapes = tower_shapes(spec)
    layers = []
    for i, (layer, (r, c)) in enumerate(sorted(shapes.items())):
        one, other = ("row", "col") if layer.startswith("emb") else ("col", "row")
        layers.append(f"""(SELECT list(x ORDER BY {one}) FROM (SELECT {one}, list(v ORDER BY {other}) AS x FROM
  (SELECT id // {c} AS row, id % {c} AS col, ((id * 7919 + {i * 31}) % 1000)::DOUBLE / 5000::DOUBLE - 0.1::DOUBLE AS v
   FROM range({r * c}) t(id)) e GROUP BY {one}) l) AS w_{layer}""")

    def looked(layer, x):
        return f"w_{layer}[1 + CASE WHEN {x} BETWEEN 0 AND {shapes[layer][0] - 1} THEN {x} ELSE 1 END]"

    def dense(layer, x):
        return f"list_transform(w_{layer}, lambda c: greatest(list_dot_product({x}, c), 0::DOUBLE))"

    parts = [looked(layer, c) for c, layer in spec.sparse.items()]
    if spec.dense:
        parts.append(dense("dense", f"[{', '.join(f'{c}::DOUBLE' for c in spec.dense)}]"))
    for c, layer in spec.sparse_seq.items():
        parts.append(f"list_transform(range(1, {shapes[layer][1] + 1}), lambda k: "
                     f"list_avg(list_transform({c}, lambda x: {looked(layer, 'x')}[k])))")
    if spec.dense_seq:
        parts.append(dense("dense_seq", f"flatten([{', '.join(spec.dense_seq)}])"))
    steps = f"t0 AS (SELECT i.*, w.*, flatten([{', '.join(parts)}]) AS x0 FROM {inputs} i, w)"
    for k in range(len(HIDDEN)):
        steps += f", t{k + 1} AS (SELECT *, {dense(f'hidden_{k}', f'x{k}')} AS x{k + 1} FROM t{k})"
    last = len(HIDDEN)
    return f"""w AS (SELECT {', '.join(layers)}),
{steps},
tower AS (SELECT *, len(v) AS n FROM (SELECT * EXCLUDE ({', '.join(f'w_{x}' for x in shapes)}),
  list_transform(w_vector, lambda c: list_dot_product(x{last}, c)::FLOAT) AS v FROM t{last}) o)"""


#: What is compared of a vector: its sum and the sum weighted by place, to 4 digits.
TOTALS = ("round(list_sum(list_transform(v, lambda x: x::DOUBLE)), 4) AS total, "
          "round(list_sum(list_transform(v, lambda x, i: x::DOUBLE * i)), 4) AS by_place")


def vector_totals(c: str) -> list:
    x = F.col(c).cast("array<double>")
    add = lambda a, y: a + y
    return [F.size(x).alias("n"), F.round(F.aggregate(x, F.lit(0.0), add), 4).alias("total"),
            F.round(F.aggregate(F.transform(x, lambda y, i: y * (i + 1)), F.lit(0.0), add), 4).alias("by_place")]


SPEC = TowerSpec(
    sparse={"s_u_click_tag_id_0_7": "emb_tag_id", "user_id": "emb_user"},
    dense=["d_u_click_cnt_0_7", "d_u_click_road_haul_max_0_7"],
    sparse_seq={"s_seq_c2b_click_tag_id_seq": "emb_tag_id"},
    dense_seq=["d_seq_c2b_click_road_haul_seq", "d_seq_c2b_click_c2b_seller_price_seq"],
)


TOP = """
SELECT * FROM (SELECT u.vec_id AS user_id, i.vec_id AS clue_id,
  row_number() OVER (PARTITION BY u.vec_id ORDER BY
    list_dot_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[]) DESC, i.vec_id) AS rank
  FROM embeddings u, embeddings i) r WHERE rank <= 20"""


def towers(t):
    users = t.vectors.select(F.col("vec_id").alias("user_id"),
                             F.col("embedding").alias("user_embedding"))
    items = t.vectors.select(F.col("vec_id").alias("clue_id"),
                             F.col("embedding").alias("item_embedding"))
    return users, items


@query("m6_top_items", f"SELECT user_id, clue_id, cast(rank AS INT) AS rank FROM ({TOP}) t")
def _(t):
    """Small blocks, so that there are many of them."""
    return top_items(*towers(t), 20, block_rows=50).select("user_id", "clue_id", "rank")


@query("m6_recall_at_n", f"""
WITH truth AS (SELECT DISTINCT cast(user_id AS BIGINT) AS user_id, cast(clue_id AS BIGINT) AS clue_id
  FROM behaviour WHERE action = 'bid'),
known AS (SELECT * FROM truth WHERE user_id IN (SELECT vec_id FROM embeddings)
  AND clue_id IN (SELECT vec_id FROM embeddings))
SELECT count(*) AS positives, count(t.rank) AS found, round(count(t.rank) / count(*), 6) AS recall
FROM known k LEFT JOIN ({TOP}) t ON k.user_id = t.user_id AND k.clue_id = t.clue_id""")
def _(t):
    truth = t.behaviour.where("action = 'bid'").select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("clue_id").cast("bigint").alias("clue_id"))
    return recall_at_n(*towers(t), truth, 20)


DIFF_COLS = ("model_price", "seller_price", "car_level")


@query("m7_feature_diff", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) AS compared,
  cast(sum(CASE WHEN a.{c} IS NOT DISTINCT FROM b.{c} THEN 0 ELSE 1 END) AS BIGINT) AS mismatched,
  round(sum(CASE WHEN a.{c} IS NOT DISTINCT FROM b.{c} THEN 0 ELSE 1 END) / count(*)::DOUBLE, 6) AS rate
FROM prices_run a FULL JOIN prices_snap b ON a.clue_id = b.clue_id""" for c in DIFF_COLS))
def _(t):
    """Latest prices as of two days."""
    from checks.fixtures import SNAP

    return C.feature_diff(t.prices(RUN), t.prices(SNAP), ["clue_id"], DIFF_COLS)


@query("m8_vector_diff", """
SELECT count(*) FILTER (a.vec_id IS NOT NULL AND b.vec_id IS NOT NULL) AS compared,
  count(*) FILTER (a.vec_id IS NULL OR b.vec_id IS NULL) AS unpaired,
  count(*) FILTER (a.vec_id IS NOT NULL AND b.vec_id IS NOT NULL
    AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding) < 1 - 1e-6) AS different,
  round(min(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding)), 6) AS min_cosine
FROM embeddings a FULL JOIN old_vectors b ON a.vec_id = b.vec_id""")
def _(t):
    return C.vector_diff(t.vectors, t.old_vectors)


@query("m9_daily_auc", f"""
SELECT d.dt, d.rows, d.positives, round(d.auc, 4) AS auc, g.gauc FROM ({per('dt')}) d
LEFT JOIN (SELECT dt, round(sum(auc * rows) / sum(rows), 4) AS gauc
  FROM ({per('dt', 'recommend_id')}) q WHERE auc IS NOT NULL GROUP BY dt) g ON d.dt = g.dt""")
def _(t):
    return M.daily_auc(t.scored)


ARMS = "CASE WHEN cast(user_id AS INT) % 2 = 0 THEN 'control' ELSE 'test' END"


def _lift(g):
    return (f"CASE WHEN control_{g} > 0 THEN round((test_{g} - control_{g}) / control_{g}::DOUBLE, 6) "
            f"END AS lift_{g}")


@query("m10_experiment_lift", f"""
SELECT *, {_lift('pv')}, {_lift('pair')}, {_lift('item')} FROM (SELECT action,
  count(*) FILTER (arm = 'control') AS control_pv,
  count(DISTINCT (user_id, clue_id)) FILTER (arm = 'control') AS control_pair,
  count(DISTINCT clue_id) FILTER (arm = 'control') AS control_item,
  count(*) FILTER (arm = 'test') AS test_pv,
  count(DISTINCT (user_id, clue_id)) FILTER (arm = 'test') AS test_pair,
  count(DISTINCT clue_id) FILTER (arm = 'test') AS test_item
  FROM (SELECT *, {ARMS} AS arm FROM behaviour) b GROUP BY action) s""")
def _(t):
    return M.experiment_lift(t.behaviour.withColumn("arm", F.expr(ARMS)))
