"""Fit and apply the statistics that turn a feature table into model inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import (
    hash_bucket, pad_array, pad_dense_global, pad_dense_local, parse_array, standardize,
    standardize_array,
)
from paddock.functions.scalars import USER_BUCKETS
from paddock.operators.aggregates import scaler_long
from paddock.operators.encoding import encode_categories, encode_sequences
from paddock.operators.filters import blank_to_null, cast_families, feature_families, fill_defaults
from paddock.operators.quantiles import fit_medians, long_values
from paddock.plans import names as N
from paddock.sources.payloads import encode_arrays_json
from paddock.sources.stats import stats_dict, stats_frame

RAW_PAD = "-1"


def prepare(df: DataFrame, families: dict) -> DataFrame:
    """Blank to null, sequence text to arrays, sparse null to 1, types, hashed user id."""
    df = blank_to_null(df)
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    to = {**{c: "int" for c in families["s_seq"]}, **{c: "double" for c in families["d_seq"]}}
    df = df.select(*[
        (parse_array(c, to[c]) if c in text else F.col(c).cast(f"array<{to[c]}>")).alias(c)
        if c in to else F.col(c)
        for c in df.columns
    ])
    sparse = families["s_u"] + families["s_i"]
    df = cast_families(fill_defaults(df, sparse, 1), families)
    return df.withColumns({
        "original_user_id": F.col("user_id"),
        "user_id": hash_bucket("user_id", USER_BUCKETS),
    })


def fit(df: DataFrame, families: dict, local: bool = False) -> DataFrame:
    """Statistics of prepared rows: medians first, then mean and scale after filling.

    A sketch and a count for the medians of all columns, one pass for all scales.
    What leaves the cluster is one row per feature column.
    """
    dense, seqs = families["d_u"] + families["d_i"], families["d_seq"]
    medians = {r["feature"]: r["median"] for r in fit_medians(df, dense, seqs).collect()}
    filled = fill_missing(df, families, medians, local=local)
    rows = {c: {"kind": kind, "median": medians.get(c), "mean": None, "scale": 1.0}
            for kind, cols in (("dense", dense), ("sequence", seqs)) for c in cols}
    if rows:
        for r in scaler_long(long_values(filled, dense, seqs).where("value is not null")).collect():
            rows[r["feature"]] |= {"mean": r["mean"], "scale": r["scale"]}
    return stats_frame(df.sparkSession, rows)


def fill_missing(df: DataFrame, families: dict, medians: dict, k: int = N.SEQ_LENGTH,
                 local: bool = False) -> DataFrame:
    """Dense null to the median; short dense sequences padded to ``k``.

    Sequences are padded with the global median, or with their own (``local``).
    A column that was never seen has no median and stays null.
    """
    dense, seqs = set(families["d_u"] + families["d_i"]), set(families["d_seq"])
    pad = pad_dense_local if local else pad_dense_global

    def cell(c):
        m = F.lit(medians.get(c)).cast("double")
        if c in dense:
            return F.coalesce(F.col(c).cast("double"), m).alias(c)
        return pad(c, m, k).alias(c) if c in seqs else F.col(c)

    return df.select(*[cell(c) for c in df.columns])


def scale(df: DataFrame, stats: dict) -> DataFrame:
    """(x - mean) / scale for every column with statistics."""

    def cell(c):
        s = stats.get(c)
        if s is None or s["mean"] is None:
            return F.col(c)
        mean, dev = F.lit(s["mean"]), F.lit(s["scale"])
        if s["kind"] == "dense":
            return standardize(c, mean, dev).alias(c)
        return standardize_array(c, mean, dev).alias(c)

    return df.select(*[cell(c) for c in df.columns])


def _finish(df: DataFrame, families: dict, stats: DataFrame, as_json: bool,
            local: bool = False) -> DataFrame:
    known = stats_dict(stats)
    medians = {c: s["median"] for c, s in known.items()}
    out = scale(fill_missing(df, families, medians, local=local), known)
    return encode_arrays_json(out, families["s_seq"] + families["d_seq"]) if as_json else out


def preprocess_fit(df: DataFrame, as_json: bool = True, local: bool = False):
    """(model inputs, statistics) of a training range; columns as in the daily job.

    ``local`` pads a short sequence with its own median in place of that of all.
    """
    families = feature_families(df)
    ready = prepare(df, families)
    stats = fit(ready, families, local)
    return _finish(ready, families, stats, as_json, local), stats


def preprocess_apply(df: DataFrame, stats: DataFrame, as_json: bool = True,
                     local: bool = False) -> DataFrame:
    """Model inputs under statistics fitted before, in the same way of padding."""
    families = feature_families(df)
    return _finish(prepare(df, families), families, stats, as_json, local)


def dictionary_names() -> dict[str, str]:
    """Encoded feature -> dictionary name, from the definitions of the features."""
    out = {feature: name for _, feature, name in N.ITEM_SPARSE}
    favourites = {**N.action_favourites(), **N.order_favourites("0_30"), **N.order_favourites("0_365")}
    out.update({feature: N.cluster_name(spec[-1]) for feature, spec in favourites.items()})
    for action in N.SEQ_ACTIONS:
        for name in N.SEQ_SPARSE.values():
            out[N.seq_name("s", action, name)] = name
    return out


#: What a column's own name says of its attribute: item, user (action, window of days), sequence.
NAMED = (r"s_i_(.+)", r"s_u_[^_]+_(.+)_\d+_\d+", r"s_seq_[^_]+_[^_]+_(.+)_seq")


def attribute_of(column: str) -> str:
    """The dictionary name of a feature: as defined, else as its own name says, else that name."""
    if column in dictionary_names():
        return dictionary_names()[column]
    found = next((m for m in (re.fullmatch(p, column) for p in NAMED) if m), None)
    return found[1] if found else column


def encode_raw(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Raw categories to ids: scalars, and sequences padded with '-1' first.

    Columns whose attribute is not in the dictionary stay as they are.
    """
    families = feature_families(df)
    known = {r["fea_name"] for r in dictionary.select("fea_name").distinct().collect()}
    padded = set(families["s_seq"])
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    df = df.select(*[
        pad_array(parse_array(c, "string") if c in text else c, N.SEQ_LENGTH, RAW_PAD).alias(c)
        if c in padded else F.col(c)
        for c in df.columns
    ])
    scalars = {c: attribute_of(c) for c in families["s_u"] + families["s_i"] if attribute_of(c) in known}
    arrays = {c: attribute_of(c) for c in families["s_seq"] if attribute_of(c) in known}
    if scalars:
        df = encode_categories(df, scalars, dictionary)
    return encode_sequences(df, arrays, dictionary) if arrays else df


def preprocess_raw(df: DataFrame, dictionary: DataFrame, stats: DataFrame | None = None,
                   as_json: bool = True):
    """Fit (no ``stats``) or apply on a table with raw categories."""
    coded = encode_raw(blank_to_null(df), dictionary)
    if stats is None:
        return preprocess_fit(coded, as_json)
    return preprocess_apply(coded, stats, as_json)
