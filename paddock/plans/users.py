"""User features: counts, statistics, favourite categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.aggregates import favourites_long, pivot_max, pivot_stats
from paddock.operators.encoding import encode_long
from paddock.operators.joins import assemble_user, join_user_features
from paddock.plans import names as N

NO_FAVOURITE = "-1"


def encoded_favourites(ratios: DataFrame, by, ratio, cols: dict,
                       dictionary: DataFrame, key=("user_id",), placed: bool = False) -> DataFrame:
    """One row per ``key`` with the dictionary id of each favourite category.

    ``by`` starts with the key; ``cols`` gives the values of the rest of it.  ``ratio``
    may name several columns, as one pass: the first of the values is then its name.
    With ``placed`` the rows of a key lie in one task already.

    The favourites are encoded while they are rows, by one join, and pivoted
    after that.  A user who is in the table but has no rows in some category
    gets the code of '-1' there, which is known where -1 is itself a value.
    """
    by, key = list(by), list(key)
    several = not isinstance(ratio, str)
    rest = (["ratio"] if several else []) + by[len(key):]
    # One shuffle by user serves both groupings and the star join; a user holds at
    # most one row per category value, so no user is large here.
    best = favourites_long(ratios if placed else ratios.repartition(*key), by, list(ratio) if several else [ratio])
    best = best.withColumn("best_key", F.coalesce("best_key", F.lit(NO_FAVOURITE)))
    cluster = F.col("cluster")
    name = F.when(cluster.isin(*N.PREFIXED_CLUSTERS), F.concat(F.lit("c2b_"), cluster))
    coded = encode_long(best, name.otherwise(cluster), F.col("best_key"), dictionary)
    aggs = []
    for out, values in cols.items():
        here = F.lit(True)
        for c, v in zip(rest, values):
            here = here & (F.col(c) == v)
        aggs.append(F.max(F.when(here, F.col("encode_id"))).alias(out))
    # at most one entry per feature
    none = dictionary.where(F.col("fea_val") == NO_FAVOURITE).agg(
        F.map_from_entries(F.collect_list(F.struct("fea_name", "encode_id")))).scalar()
    return coded.groupBy(*key).agg(*aggs).select(*key, *[
        F.coalesce(F.col(out), F.element_at(none, F.lit(N.cluster_name(values[-1]))), F.lit(1))
        .alias(out)
        for out, values in cols.items()
    ])


def encoded_order_favourites(convert_ratio: DataFrame, dictionary: DataFrame, key=("user_id",),
                             placed: bool = False) -> DataFrame:
    """The favourites of the orders of both windows, from one pass over the ratios."""
    cols = {out: (f"ratio_{w}", *values) for w in ("0_30", "0_365") for out, values in N.order_favourites(w).items()}
    return encoded_favourites(
        convert_ratio, (*key, "cluster"), ("ratio_0_30", "ratio_0_365"), cols, dictionary, key, placed)


def convert_counts(convert_cnt: DataFrame, key=("user_id",)) -> DataFrame:
    return convert_cnt.select(
        *key,
        F.coalesce("cnt_0_30", F.lit(0)).cast("int").alias("d_u_contract_cnt_30"),
        F.coalesce("cnt_0_365", F.lit(0)).cast("int").alias("d_u_contract_cnt_365"))


def user_offline_features(action_cnt: DataFrame, convert_cnt: DataFrame, action_statis: DataFrame,
                          convert_statis: DataFrame, action_ratio: DataFrame,
                          convert_ratio: DataFrame, dictionary: DataFrame,
                          key=("user_id",), placed: bool = False) -> DataFrame:
    """One row per user with counted actions: 47 dense and 50 sparse features.

    Counts without a source are 0, statistics stay null, categories are 1.
    With ("dt", "user_id") as ``key`` the inputs hold the snapshots of many days
    and so does the result.  ``placed``: the ratios of a key lie in one task already.
    """
    key = list(key)
    counts = N.action_count_columns()
    spine = pivot_max(action_cnt.where("user_id is not null"), key, counts)
    stats = pivot_stats(action_statis, key, N.action_stat_columns())
    # orders carry the name of their conversion in place of the action
    deals = convert_statis.withColumnRenamed("convert", "action")
    deals = pivot_stats(deals, key, N.order_stat_columns())
    acted = encoded_favourites(
        action_ratio, (*key, "action", "cluster"), "ratio_0_7", N.action_favourites(),
        dictionary, key, placed)
    ordered = encoded_order_favourites(convert_ratio, dictionary, key, placed)
    wide = assemble_user(
        spine, convert_counts(convert_cnt, key), stats, deals, acted, ordered, on=key)

    seen = [c for c in counts if "_beseen_" in c]
    zero = [c for c in counts if c not in seen] + ["d_u_contract_cnt_30", "d_u_contract_cnt_365"]
    dense = list(N.action_stat_columns()) + list(N.order_stat_columns())
    sparse = [*N.action_favourites(), *N.order_favourites("0_30"), *N.order_favourites("0_365")]
    return wide.select(
        *key, *seen,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in zero],
        *dense,
        *[F.coalesce(F.col(c), F.lit(1)).alias(c) for c in sparse],
    )


def refresh_user_features(action_cnt: DataFrame, convert_cnt: DataFrame, action_statis: DataFrame,
                          action_ratio: DataFrame, convert_ratio: DataFrame,
                          dictionary: DataFrame) -> DataFrame:
    """One row per user with counted actions: the 32 dense and 50 sparse inputs of the refresh.

    Statistics are the largest of all windows, and 0 for an action a user has not;
    what a user has no row for at all stays null, categories are 1.
    """
    spine = pivot_max(action_cnt.where("user_id is not null"), "user_id", N.refresh_count_columns())
    stats = pivot_max(action_statis, "user_id", N.refresh_stat_columns())
    acted = encoded_favourites(
        action_ratio, ("user_id", "action", "cluster"), "ratio_0_7", N.action_favourites(), dictionary)
    ordered = encoded_order_favourites(convert_ratio, dictionary)
    wide = assemble_user(spine, convert_counts(convert_cnt), stats, acted, ordered)
    return wide.select(
        "user_id", *[F.col(c).cast("double").alias(c) for c in N.refresh_dense()],
        *[F.coalesce(F.col(c), F.lit(1)).alias(c) for c in N.refresh_sparse()])


def sample_user_features(samples: DataFrame, users: DataFrame, on="user_id") -> DataFrame:
    """Samples with the user features of the snapshot before their day."""
    return join_user_features(samples, users, on)
