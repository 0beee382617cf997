"""Row filters and column guards."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions import safe_int

# Page types of the search scene, and feature name prefixes.
SCENE_LIKE, SCENE_NOT_LIKE = "%SEARCH%", "%INVITATION%"
SEARCH, GRAB = "SEARCH", "GRAB"
#: Scene: page types like the first and not like the second.
SCENES = {SEARCH: (SCENE_LIKE, SCENE_NOT_LIKE), GRAB: ("%GRAB%", "%INVITATION%")}
ACTIVE_SCENES = ("%SEARCH%", "%GRAB%")
FAMILIES = ("s_u", "d_u", "s_i", "d_i", "s_seq", "d_seq")
KEY_COLUMNS = 5


def filter_scene(df: DataFrame, like=SCENE_LIKE, not_like=SCENE_NOT_LIKE) -> DataFrame:
    page = F.col("page_type")
    return df.where(page.like(like) & ~page.like(not_like))


def filter_named_scene(df: DataFrame, scene: str) -> DataFrame:
    """The rows of one of :data:`SCENES`; an unknown name is an error."""
    return filter_scene(df, *SCENES[scene])


def filter_scene_any(df: DataFrame, likes=ACTIVE_SCENES) -> DataFrame:
    page = F.col("page_type")
    return df.where(reduce(or_, [page.like(p) for p in likes]))


def valid_ids(df: DataFrame, cols=("user_id", "clue_id"), *, above_zero=True,
              not_values=()) -> DataFrame:
    """Drop rows whose text ids are null, empty or (as text) not above '0'.

    The comparison is on text, so 'unknown' passes ``above_zero``; name it in
    ``not_values`` to drop it.
    """
    for c in cols:
        df = df.where(F.col(c).isNotNull() & (F.col(c) != ""))
        if above_zero:
            df = df.where(F.col(c) > "0")
        if not_values:
            df = df.where(~F.col(c).isin(*not_values))
    return df


def filter_actions(df: DataFrame, actions) -> DataFrame:
    return df.where(F.col("action").isin(*actions))


def int_ids(df: DataFrame, cols) -> DataFrame:
    """Text ids to int once, at the scan; malformed ids become null."""
    return df.withColumns({c: safe_int(c) for c in cols})


def on_sale(df: DataFrame) -> DataFrame:
    return df.where((F.col("sale_status") == 0) & F.col("auction_type").isin(1, 2))


def only_keys(df: DataFrame, key: str, keys) -> DataFrame:
    """Restrict a run to some keys: a short list, or a frame of any size."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(*keys))


def recent_items(df: DataFrame, min_create: str) -> DataFrame:
    """Created later than a bound; text comparison."""
    return df.where(F.col("create_time") > min_create)


def feature_families(df: DataFrame) -> dict[str, list[str]]:
    """Feature columns by name prefix, in the model's order.

    By position: five key columns first, the day last; sequences of item ids
    are not model inputs; ``user_id`` counts as a sparse user feature.
    """
    middle = df.columns[KEY_COLUMNS:-1]
    out = {f: [c for c in middle if c.startswith(f + "_")] for f in FAMILIES}
    out["s_seq"] = [c for c in out["s_seq"] if "clue_id" not in c]
    out["s_u"] = out["s_u"] + ["user_id"]
    return out


def model_order(families: dict) -> list[str]:
    return [c for f in ("s_u", "d_u", "s_seq", "d_seq", "s_i", "d_i") for c in families[f]]


def array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def fill_defaults(df: DataFrame, cols, value) -> DataFrame:
    cols = set(cols)
    return df.select(*[
        F.coalesce(F.col(c), F.lit(value)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def namespaced(df: DataFrame, prefix: str = "", suffix: str = "", keep=()) -> DataFrame:
    """Put source columns into the feature namespace."""
    return df.withColumnsRenamed(
        {c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keep}
    )


def blank_to_null(df: DataFrame) -> DataFrame:
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns
    ])


def cast_families(df: DataFrame, families: dict) -> DataFrame:
    """Sparse to int, dense to float, label to int."""
    to = {c: "int" for c in families["s_u"] + families["s_i"] + ["label"]}
    to.update({c: "float" for c in families["d_u"] + families["d_i"]})
    return df.select(*[F.col(c).cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns])
