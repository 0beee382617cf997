"""Array and vector expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "pad_array", "join_array", "parse_array", "pad_dense_global", "pad_dense_local",
    "array_median", "lower_median", "array_mean", "map_array", "map_value",
    "standardize_array", "cosine", "dot", "norm", "vector_to_text", "text_to_vector",
    "to_json_array", "from_json_array",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name(c) -> str:
    return "`" + c.replace("`", "``") + "`"


def pad_array(arr, k: int, value, dtype: str = "string") -> Column:
    """Right-pad to ``k``; null counts as empty; longer arrays stay as they are."""
    if isinstance(arr, str) and not isinstance(value, Column):
        # as SQL text: wide tables pad dozens of columns by name
        return F.expr(
            f"concat(coalesce(cast({_name(arr)} as array<{dtype}>), cast(array() as array<{dtype}>)), "
            f"array_repeat(cast('{value}' as {dtype}), "
            f"greatest({k} - coalesce(size({_name(arr)}), 0), 0)))")
    fill = value if isinstance(value, Column) else F.lit(value)
    fill = fill.cast(dtype)
    known = F.coalesce(_col(arr).cast(f"array<{dtype}>"), F.array().cast(f"array<{dtype}>"))
    missing = F.greatest(F.lit(k) - F.size(known), F.lit(0))
    return F.concat(known, F.array_repeat(fill, missing))


def join_array(arr) -> Column:
    """Comma text; nulls inside are skipped and shorten the text."""
    return F.concat_ws(",", _col(arr).cast("array<string>"))


def parse_array(text, dtype: str = "double") -> Column:
    """Comma text to array; null or '' gives null."""
    text = F.nullif(_col(text), F.lit(""))
    return F.split(text, ",").cast(f"array<{dtype}>")


def pad_dense_global(arr, median, k: int = 10) -> Column:
    """Short or missing dense sequences end in copies of the global median."""
    return pad_array(arr, k, median, "double")


def array_median(arr) -> Column:
    """Interpolated median of the non-null elements; null if there are none."""
    asc = F.array_sort(F.array_compact(_col(arr).cast("array<double>")))
    n = F.size(asc)
    low = F.get(asc, F.floor((n - 1) / 2).cast("int"))
    high = F.get(asc, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def lower_median(arr: str) -> Column:
    """Smallest element with at least half of the elements at or below it."""
    known = f"array_compact({_name(arr)})"
    return F.expr(f"get(array_sort({known}), cast((size({known}) - 1) div 2 as int))")


def array_mean(arr: str) -> Column:
    """Mean of the non-null elements; null if there are none."""
    known = f"array_compact(cast({_name(arr)} as array<double>))"
    return F.expr(f"try_divide(aggregate({known}, cast(0 as double), (a, x) -> a + x), size({known}))")


def pad_dense_local(arr, median, k: int = 10) -> Column:
    """Short sequences end in copies of their own median, missing ones in the global."""
    arr = _col(arr).cast("array<double>")
    empty = F.coalesce(F.size(arr), F.lit(0)) <= 0
    fill = F.when(empty, F.lit(median).cast("double")).otherwise(array_median(arr))
    return pad_array(arr, k, fill, "double")


def map_value(c, mapping: Column, default: int = 1) -> Column:
    """Dictionary lookup of one value."""
    key = _col(c).cast("string")
    return F.coalesce(F.when(key.isNotNull(), F.element_at(mapping, key)), F.lit(default))


def map_array(arr, mapping: Column, default: int = 1) -> Column:
    """Dictionary lookup of every element."""
    return F.transform(
        _col(arr).cast("array<string>"), lambda x: map_value(x, mapping, default)
    )


def standardize_array(arr, mean, scale) -> Column:
    return F.transform(_col(arr), lambda x: (x - mean) / scale)


def dot(a, b) -> Column:
    """Inner product in double precision."""
    pairs = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine; null for a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size)


def vector_to_text(v) -> Column:
    """'[a,b,...]'."""
    return F.concat(F.lit("["), F.concat_ws(",", _col(v).cast("array<string>")), F.lit("]"))


def text_to_vector(text, dtype: str = "float") -> Column:
    return F.from_json(_col(text), f"array<{dtype}>")


def to_json_array(arr) -> Column:
    return F.to_json(_col(arr))


def from_json_array(text, dtype: str = "double") -> Column:
    return F.from_json(_col(text), f"array<{dtype}>")
