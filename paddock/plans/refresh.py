"""Refresh of stored vectors: features, tower, difference to the last run, payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import hash_bucket, standardize, vector_to_text
from paddock.functions.scalars import USER_BUCKETS
from paddock.operators.aggregates import distinct_rows
from paddock.operators.compare import changed_embeddings, refresh_all
from paddock.operators.filters import filter_actions, filter_scene_any, valid_ids
from paddock.operators.towers import TowerSpec, tower_forward
from paddock.plans.items import item_table, sale_items
from paddock.sources.payloads import kv_payload, upsert_payload
from paddock.sources.sinks import write_csv
from paddock.sources.stats import stats_dict
from paddock.sources.tables import read_tsv, scan_window
from paddock.sources.versions import read_version, write_version

# Days that make a user active, and the shape of the store's keys.
ACTIVE_DAYS = 7
KEY_FORMAT = "user_vector:%s"


def active_users(behaviour: DataFrame, run_date: str) -> DataFrame:
    """Users who saw an item in an active scene in the last days."""
    window = filter_scene_any(scan_window(behaviour, run_date, -ACTIVE_DAYS, 0))
    seen = valid_ids(filter_actions(window, ["beseen"]), ["user_id"], above_zero=False)
    ids = seen.select(F.expr("try_cast(user_id as int)").alias("user_id"))
    # one user may have several spellings ('1', '01'); malformed ids name nobody
    return distinct_rows(ids.where("user_id is not null"), ["user_id"])


def model_inputs(features: DataFrame, sparse, dense, stats: DataFrame) -> DataFrame:
    """Medians for missing dense values, 1 for missing categories, then scaling."""
    known = stats_dict(stats)
    cells = []
    for c in features.columns:
        if c in dense:
            s = known[c]
            value = F.coalesce(F.col(c).cast("double"), F.lit(s["median"]))
            cells.append(standardize(value, F.lit(s["mean"]), F.lit(s["scale"])).alias(c))
        elif c in sparse:
            cells.append(F.coalesce(F.col(c), F.lit(1)).cast("int").alias(c))
        else:
            cells.append(F.col(c))
    return features.select(*cells)


def user_vectors(users: DataFrame, features: DataFrame, stats: DataFrame, weights, spec: TowerSpec) -> DataFrame:
    """(user_id, embedding) of the given users; ``spec`` may use ``user_bucket``."""
    wide = users.join(features, "user_id", "left")
    ready = model_inputs(wide, set(spec.sparse), set(spec.dense), stats)
    ready = ready.withColumn("user_bucket", hash_bucket("user_id", USER_BUCKETS))
    return tower_forward(ready, weights, spec, "user_id")


def refreshed(new: DataFrame, key: str, store: str, run_date: str, pick) -> tuple[DataFrame, DataFrame]:
    """(vectors of this run, those to write): the vectors are made once, as a version of ``store``.

    What changed follows from this version and the one that was current, whatever day
    and hour that was; a run that fails leaves the one before.
    """
    spark = new.sparkSession
    rows = new.select(key, "embedding")
    old = read_version(spark, store, schema=rows.schema)
    now = write_version(rows, store, f"{run_date}-{uuid.uuid4().hex[:8]}")
    return now, pick(now, old, key)


def refresh_user_vectors(behaviour: DataFrame, features: DataFrame, stats: DataFrame,
                         weights, spec: TowerSpec, store: str, run_date: str):
    """(all vectors, changed ones, payload of the changed ones); the vectors become a version of ``store``."""
    new = user_vectors(active_users(behaviour, run_date), features, stats, weights, spec)
    now, changed = refreshed(new, "user_id", store, run_date, changed_embeddings)
    return now, changed, kv_payload(changed, KEY_FORMAT)


def refresh_item_vectors(sale: DataFrame, prices: DataFrame, rates, dictionary: DataFrame,
                         stats: DataFrame, weights, spec: TowerSpec, store: str,
                         run_date: str, model_version: str, changed_only: bool = False,
                         names=None):
    """(all vectors, rows to write, payload) of the items on sale.

    Every item is written again, as the job does; ``changed_only`` applies the
    cosine test instead.
    """
    table = item_table(sale_items(sale), prices, rates, dictionary, run_date, names)
    ready = model_inputs(table, set(spec.sparse), set(spec.dense), stats)
    new = tower_forward(ready, weights, spec, "clue_id")
    pick = changed_embeddings if changed_only else refresh_all
    now, todo = refreshed(new, "clue_id", store, run_date, pick)
    return now, todo, upsert_payload(todo, model_version)


def write_vectors(vectors: DataFrame, path: str, key="user_id", vector="embedding",
                  one_file: bool = False) -> None:
    """Tab-separated export with the vector as text."""
    text = vectors.select(key, vector_to_text(vector).alias(vector))
    write_csv(text, path, sep="\t", one_file=one_file)


def read_vectors(spark, path: str, key="user_id", vector="embedding") -> DataFrame:
    """The export read back; no rows where there is none yet."""
    raw = read_tsv(spark, path, f"{key} int, {vector} string")
    return raw.select(key, F.from_json(vector, "array<float>").alias(vector))
