import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.operators import compare as C
from paddock.operators import evaluate as M
from paddock.operators.retrieval import ItemBlocks, pack_items, search, top_items
from paddock.operators.towers import TowerSpec, forward, tower_forward
from paddock.sources.models import PackedModel, pack_weights


def pair_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def scored(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "a", "a", "b", "c"]), rnd.randint(0, 1), rnd.randint(0, 9) / 10)
            for _ in range(300)] + [("d", 1, 0.3)] * 3
    return rows, spark.createDataFrame(rows, "recommend_id string, label int, score double")


def test_auc_counts_pairs_with_ties(spark):
    rows, df = scored(spark)
    assert M.auc(df).first()["auc"] == pytest.approx(pair_auc([(y, s) for _, y, s in rows]))
    per = {r.recommend_id: r.auc for r in M.group_auc(df, "recommend_id").collect()}
    weighted, total = 0.0, 0
    for g in "abcd":
        part = [(y, s) for h, y, s in rows if h == g]
        want = pair_auc(part)
        assert per[g] == (None if want is None else pytest.approx(want))
        if want is not None:
            weighted, total = weighted + want * len(part), total + len(part)
    assert M.gauc(df).first()["gauc"] == round(weighted / total, 4)


def test_single_label(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.1)], "recommend_id string, label int, score double")
    assert M.gauc(df).first()["gauc"] is None
    assert M.gauc(df, one_label=0.5).first()["gauc"] == 0.5
    assert M.auc(df).first()["auc"] is None


def test_all_scores_tied(spark):
    df = spark.createDataFrame([("a", i % 2, 0.5) for i in range(10)],
                               "recommend_id string, label int, score double")
    assert M.auc(df).first()["auc"] == 0.5 and M.gauc(df).first()["gauc"] == 0.5


def test_changed_vectors(spark):
    new = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 1e-9]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, [1.0, 0.0])],
        "user_id int, embedding array<double>")
    old = spark.createDataFrame(
        [(2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, [1.0, 0.0])],
        "user_id int, embedding array<double>")
    got = {r.user_id: r.reason for r in C.changed_embeddings(new, old).collect()}
    assert got == {1: "new", 3: "changed", 4: "changed"}
    assert C.refresh_all(new, old, "user_id").where("reason = 'existing'").count() == 4


def test_feature_diff_counts_nulls_and_missing_keys(spark):
    a = spark.createDataFrame([(1, 5, None), (2, 6, 1)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5, None), (2, 7, 1), (3, 1, None)], "k int, x int, y int")
    got = {r.feature: (r.compared, r.mismatched) for r in C.feature_diff(a, b, ["k"]).collect()}
    assert got == {"x": (3, 2), "y": (3, 0)}


def test_top_items_by_falling_norm(spark):
    rnd = np.random.default_rng(0)
    u, i = rnd.normal(size=(30, 8)), rnd.normal(size=(900, 8)) * rnd.exponential(size=(900, 1)) ** 2
    i[700:720] = i[int(np.argmax((i * i).sum(axis=1)))]  # ties among the best
    users = spark.createDataFrame([(k, list(map(float, v))) for k, v in enumerate(u)] + [(99, None)],
                                  "user_id long, user_embedding array<double>")
    items = spark.createDataFrame([(k, list(map(float, v))) for k, v in enumerate(i)] + [(5000, None)],
                                  "clue_id long, item_embedding array<double>")
    scores = np.round(u @ i.T, 9)
    order = np.lexsort([np.broadcast_to(np.arange(900), scores.shape), -scores], axis=1)[:, :12]
    for rows in (16, 4096):
        top = top_items(users, items, 12, block_rows=rows)
        got = {(r.user_id, r["rank"]): r.clue_id for r in top.collect()}
        assert got == {(k, n + 1): order[k, n] for k in range(30) for n in range(12)}
    few = top_items(users, items.where("clue_id < 3"), 12).groupBy("user_id").count().collect()
    assert {(r.user_id, r["count"]) for r in few} == {(k, 3) for k in range(30)}
    assert top_items(users, items.limit(0), 12).count() == 0
    # the bound leaves most products out, and a worker keeps few blocks
    blocks = ItemBlocks(pack_items(items, "clue_id", "item_embedding", 16), kept_bytes=3000)
    found, ids, made = search(blocks, u, 12)
    assert np.array_equal(ids, order) and made < 0.6 * scores.size and blocks.held <= 3000
    assert [n for n, _ in blocks.order] == sorted((n for n, _ in blocks.order), reverse=True)


def test_a_block_is_read_from_its_own_row_group(spark, monkeypatch):
    from paddock.operators import retrieval

    monkeypatch.setattr(retrieval, "GROUP_BYTES", 4096)
    items = spark.range(3000).selectExpr(
        "id as clue_id", "transform(sequence(1, 16), i -> cast(id % 97 + i as double)) as item_embedding")
    blocks = ItemBlocks(pack_items(items.coalesce(1), "clue_id", "item_embedding", 16))
    assert len({(g.path, g.row_groups[0].id) for g in blocks.group}) > 3
    for k in (0, 5, len(blocks.order) - 1):
        ids, vectors = blocks.read(k)
        assert np.array_equal(vectors[:, 0], ids % 97 + 1.0)
        assert np.sqrt((vectors * vectors).sum(axis=1)).max() == pytest.approx(blocks.order[k][0])


def test_tower_matches_numpy(spark):
    from checks.q_evaluation import tower_weights

    spec = TowerSpec(sparse={"a": "emb_a"}, dense=["x", "y"], sparse_seq={"s": "emb_a"},
                     dense_seq=["d"])
    weights = tower_weights(spark, spec)
    rows = [(k, k % 5, k * 0.1, -0.2 * k, [k % 7] * 10, [0.1 * k] * 10) for k in range(20)]
    df = spark.createDataFrame(
        rows, "id int, a int, x double, y double, s array<int>, d array<double>")
    got = {r.id: np.array(r.embedding) for r in tower_forward(df, weights, spec, "id").collect()}
    w = PackedModel(pack_weights(weights))
    flat = weights.toPandas()
    for layer, part in flat.groupby("layer"):
        want = np.zeros((part["row"].max() + 1, part["col"].max() + 1))
        want[part["row"], part["col"]] = part["value"]
        assert np.array_equal(w.matrix(layer), want)
    model, w = w, {layer: w.matrix(layer) for layer in w.shapes}
    for k, a, x, y, s, d in rows:
        dense = np.maximum(np.array([x, y]) @ w["dense"], 0)
        seq = np.maximum(np.array(d) @ w["dense_seq"], 0)
        v = np.concatenate([w["emb_a"][a], dense, w["emb_a"][s].mean(axis=0), seq])
        for h in ("hidden_0", "hidden_1"):
            v = np.maximum(v @ w[h], 0)
        assert got[k] == pytest.approx(v @ w["vector"], abs=1e-4)
    assert forward(df.toPandas(), spec, model).shape == (20, 32)


def test_experiment_lift(spark):
    df = spark.createDataFrame(
        [("bid", "control", 1, 1), ("bid", "control", 1, 1), ("bid", "test", 2, 1), ("bid", "test", 2, 2),
         ("bid", "test", 3, 2)], "action string, arm string, user_id int, clue_id int")
    r = M.experiment_lift(df).first()
    assert (r.control_pv, r.test_pv, r.control_pair, r.test_pair, r.test_item) == (2, 3, 1, 3, 2)
    assert (r.lift_pv, r.lift_pair, r.lift_item) == (0.5, 2.0, 1.0)


def test_search_memory_is_bounded_by_the_rows_scored_together(spark, monkeypatch):
    """A worker keeps the blocks that every search starts with, and scores few rows at a time."""
    from paddock.operators import retrieval as R

    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    items = spark.createDataFrame(rows, "clue_id long, item_embedding array<double>")
    blocks = ItemBlocks(pack_items(items.coalesce(1), "clue_id", "item_embedding", 16), kept_bytes=2000)
    vectors, shapes, best = np.array([v for _, v in rows]), [], R._best
    want = search(blocks, vectors, 5)
    assert 0 in blocks.cache and blocks.held <= 2000
    monkeypatch.setattr(R, "_best", lambda s, i, n: (shapes.append(s.shape[0]), best(s, i, n))[1])
    monkeypatch.setattr(R, "SCORED_ROWS", 30, raising=False)
    got = search(blocks, vectors, 5)
    assert max(shapes) <= 30 and all((a == b).all() for a, b in zip(want[:2], got[:2]))


def test_small_blocks_are_searched_in_long_runs_by_as_many_tasks_as_needed(spark, monkeypatch):
    from paddock.operators import retrieval as R

    draw = np.random.default_rng(3)
    v = draw.normal(size=(600, 16))
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    rows = [(k, list(map(float, x))) for k, x in enumerate(v)]
    items = spark.createDataFrame(rows, "clue_id long, item_embedding array<double>").coalesce(1)
    blocks = ItemBlocks(pack_items(items, "clue_id", "item_embedding", 8))
    runs, reads, run, read = [], [], blocks.run, blocks._read
    monkeypatch.setattr(blocks, "run", lambda k: (runs.append(k), run(k))[1])
    monkeypatch.setattr(blocks, "_read", lambda ks: (reads.append(len(ks)), read(ks))[1])
    found, ids, made = search(blocks, v, 5)
    want = np.lexsort([np.broadcast_to(np.arange(600), (600, 600)), -np.round(v @ v.T, 12)], axis=1)[:, :5]
    assert np.array_equal(ids, want) and made == 600 * 600
    assert len(blocks.order) > 40 and runs == [0] and sum(reads) == len(blocks.order)
    # a run ends where norms fall, and where it is long
    monkeypatch.setattr(R, "RUN_ROWS", 100)
    assert np.array_equal(search(blocks, v, 5)[1], want) and len(runs) > 6
    # one file of users is many tasks where there are many products
    users = items.withColumnsRenamed({"clue_id": "user_id", "item_embedding": "user_embedding"})
    assert top_items(users, items, 5).rdd.getNumPartitions() == 1
    monkeypatch.setattr(R, "TASK_PRODUCTS", 60_000)
    top = top_items(users, items, 5)
    assert top.rdd.getNumPartitions() == 6
    assert {(r.user_id, r["rank"]): r.clue_id for r in top.collect()} == {
        (k, n + 1): want[k, n] for k in range(600) for n in range(5)}


def test_scores_that_floats_cannot_tell_apart_are_ranked_exactly(spark):
    """Items that differ in the tenth digit, vectors of zeros and vectors of any size."""
    base = [1.0, 2.0, -1.0]
    rows = [(k, [x + 1e-10 * ((k * 37) % 50) for x in base]) for k in range(50)]
    rows += [(50 + k, [x * 10.0 ** e for x in base]) for k, e in enumerate((-200, -60, 0, 60, 140))] + [(60, [0.0] * 3), (61, [0.0] * 3)]
    items = spark.createDataFrame(rows, "clue_id long, item_embedding array<double>")
    asked = [(1, [1.0, 1.0, 1.0]), (2, [-1e-30, 0.0, 0.0]), (3, [0.0] * 3), (4, [1e-120, 1e-120, 0.0]), (5, [1e120, 0.0, 1e120])]
    users = spark.createDataFrame(asked, "user_id long, user_embedding array<double>")
    for size in (4, 1024):
        got = {}
        for r in top_items(users, items, 7, block_rows=size).collect():
            got.setdefault(r.user_id, []).append((r["rank"], r.clue_id))
        for u, v in asked:
            scores = [(-np.cumsum(np.array(v) * np.array(x))[-1], k) for k, x in rows]
            assert [k for _, k in sorted(got[u])] == [k for _, k in sorted(scores)[:7]], (size, u)


def test_the_range_of_a_norm_is_the_number_of_splits_below(spark):
    from paddock.operators.retrieval import _range_of

    splits = [k / 7 for k in range(100)]
    for some in ([], splits[:1], splits[:31], splits[:32], splits[:65], splits):
        values = [-1.0, 0.0, 3.3, 100.0, *splits, None]
        df = spark.createDataFrame([(x,) for x in values], "norm double").withColumn("range", _range_of("norm", some))
        assert all(r.range == (0 if r.norm is None else sum(s < r.norm for s in some)) for r in df.collect())
