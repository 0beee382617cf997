"""Packed models, versioned tables, and a refresh that makes its vectors once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.plans import refresh as RF
from paddock.sources import models as D
from paddock.sources import versions as V


def test_blocks_of_a_model_are_read_as_they_are_needed(spark):
    rnd = np.random.RandomState(1)
    big, small = rnd.rand(1000, 3), rnd.rand(4, 7)
    big[40:90] = 0  # blocks without a cell
    rows = [("big", i, j, float(v)) for (i, j), v in np.ndenumerate(big) if v] + [
        ("small", i, j, float(v)) for (i, j), v in np.ndenumerate(small)]
    path = D.pack_weights(spark.createDataFrame(rows, "layer string, row int, col int, value double"), block_rows=16)
    model = D.PackedModel(path, kept_bytes=5 * 16 * 3 * 8)
    assert model.shapes == {"big": (1000, 3), "small": (4, 7)} and "big" in model and "small_bias" not in model
    ids = rnd.randint(0, 1000, (50, 4))
    assert np.array_equal(model.rows("big", ids), big[ids])
    assert model.held <= 5 * 16 * 3 * 8 and len(model.cache) <= 5
    assert np.array_equal(model.rows("big", np.array([-1, 1000, 5])), big[[1, 1, 5]])
    assert np.array_equal(model.matrix("small"), small) and np.array_equal(model.matrix("big"), big)
    assert D.opened(path) is D.opened(path)


def test_the_driver_gets_no_weights(spark):
    rows = spark.range(200_000).select(F.lit("e").alias("layer"), (F.col("id") / 4).cast("int").alias("row"),
                                       (F.col("id") % 4).cast("int").alias("col"), F.rand(1).alias("value"))
    path = D.pack_weights(rows)
    packed = spark.read.parquet(path)
    assert packed.count() == -(-50_000 // D.BLOCK_ROWS)
    assert packed.agg(F.max(F.length("data"))).first()[0] == D.BLOCK_ROWS * 4 * 8


def test_versions_follow_a_pointer(spark, tmp_path):
    root = str(tmp_path / "vectors")
    schema = "k int, v int"
    assert V.current_version(spark, root) is None and V.list_versions(spark, root) == []
    assert V.read_version(spark, root, schema=schema).count() == 0
    frame = lambda v: spark.createDataFrame([(1, v)], schema)
    assert V.write_version(frame(1), root, "a").first().v == 1
    held = V.read_version(spark, root)
    V.write_version(frame(2), root, "b", move=False)
    assert V.read_version(spark, root).first().v == 1
    V.write_version(frame(3), root, "b")  # an attempt that was not pointed to
    assert V.current_version(spark, root) == "b" and V.list_versions(spark, root) == ["a", "b"]
    assert held.first().v == 1 and V.read_version(spark, root).first().v == 3
    with pytest.raises(ValueError):
        V.write_version(frame(4), root, "b")

    def broken(x):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        V.write_version(frame(5).select("k", F.udf(broken, "int")("v").alias("v")), root, "c")
    assert V.current_version(spark, root) == "b" and V.read_version(spark, root).first().v == 3


def test_a_refresh_makes_each_vector_once_and_compares_two_versions(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def tower(users, features, stats, weights, spec):
        def run(batches):
            for pdf in batches:
                seen.add(len(pdf))
                yield pdf

        return users.join(features, "user_id").mapInPandas(run, "user_id int, embedding array<float>")

    monkeypatch.setattr(RF, "user_vectors", tower)
    monkeypatch.setattr(RF, "active_users", lambda behaviour, day: behaviour)
    users = spark.range(60).select(F.col("id").cast("int").alias("user_id"))
    vector = lambda x: F.array(x.cast("float"), F.lit(1.0).cast("float")).alias("embedding")
    store = str(tmp_path / "users")
    before = users.where("user_id < 50").select("user_id", vector(F.col("user_id")))
    after = users.select("user_id", vector(F.when(F.col("user_id") % 10 == 3, -F.col("user_id")).otherwise(F.col("user_id"))))
    now, changed, payload = RF.refresh_user_vectors(users, before, None, None, None, store, "2024-01-26")
    assert (now.count(), changed.count(), payload.count(), seen.value) == (50, 50, 50, 50)
    now, changed, payload = RF.refresh_user_vectors(users, after, None, None, None, store, "2024-01-27")
    got = {r.user_id: r.reason for r in changed.collect()}
    assert got == {i: "new" for i in range(50, 60)} | {i: "changed" for i in (3, 13, 23, 33, 43)}
    assert (now.count(), payload.count(), seen.value) == (60, 15, 110)
    # another run of the same day finds nothing to write
    assert RF.refresh_user_vectors(users, after, None, None, None, store, "2024-01-27")[2].count() == 0
    assert len(V.list_versions(spark, store)) == 3
