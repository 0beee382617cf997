"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "safe_int", "bins", "score_segment", "price_bin", "level_ordinal",
    "diff_price", "on_shelf_days", "year_from_title", "epoch_seconds", "day_shift",
    "hash_bucket", "standardize", "price_reached", "sigmoid", "round4",
    "default_if_null",
]

# Fixed values: (exclusive lower bound, inclusive upper bound, code).
SCORE_SEGMENTS = ((0, 55, 35), (55, 69, 65), (69, 89, 80), (89, 100, 95))
PRICE_BINS = (
    (0, 20000, 2), (20000, 40000, 4), (40000, 60000, 6),
    (60000, 90000, 9), (90000, 150000, 15), (150000, 10000000, 1000),
)
LEVELS = ("A", "B", "C", "D")
USER_BUCKETS = 8001
ITEM_BUCKETS = 20001
PRICE_SHARES = {"is_daojia80": 0.8, "is_daojia90": 0.9, "is_daojia100": 1.0}
NO_BIN = -1
MODEL_YEAR_PATTERN = r"(\d+)款"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c) -> Column:
    """String to int; malformed text gives null instead of an ANSI error."""
    return F.expr(f"try_cast({c} as int)") if isinstance(c, str) else c.try_cast("int")


def bins(c, table, otherwise=NO_BIN, low_inclusive=False) -> Column:
    """Code of the first (low, high] interval of ``table`` that holds ``c``."""
    x = _col(c)
    out = None
    for i, (low, high, code) in enumerate(table):
        above = x >= low if (i == 0 and low_inclusive) else x > low
        cond = above & (x <= high)
        out = F.when(cond, code) if out is None else out.when(cond, code)
    return out.otherwise(otherwise)


def score_segment(c) -> Column:
    """Evaluation score to its segment; null or out of range gives -1."""
    return bins(c, SCORE_SEGMENTS, low_inclusive=True)


def price_bin(c) -> Column:
    """Price to its bin; null, zero or out of range gives -1."""
    return bins(c, PRICE_BINS)


def level_ordinal(c) -> Column:
    """A..D to 1..4, anything else to 0."""
    found = F.array_position(F.array(*[F.lit(v) for v in LEVELS]), _col(c))
    return F.coalesce(found, F.lit(0)).cast("int")


def diff_price(seller="seller_price", model="model_price") -> Column:
    return _col(seller) - _col(model)


def on_shelf_days(run_date: str, created="create_time") -> Column:
    return F.datediff(F.lit(run_date).cast("date"), _col(created).cast("date"))


def year_from_title(c) -> Column:
    """Digits before the model-year marker; '' if there are none."""
    return F.regexp_extract(_col(c), MODEL_YEAR_PATTERN, 1)


def epoch_seconds(c) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text to epoch seconds (session zone: UTC)."""
    return F.unix_timestamp(F.to_timestamp(_col(c), "yyyy-MM-dd HH:mm:ss"))


def day_shift(c, days: int) -> Column:
    """'yyyy-MM-dd' text moved by ``days``, as text."""
    return F.date_format(F.date_add(_col(c).cast("date"), days), "yyyy-MM-dd")


def hash_bucket(c, n: int) -> Column:
    """Integer id to [0, n)."""
    return F.pmod(_col(c), F.lit(n)).cast("int")


def standardize(c, mean, scale) -> Column:
    return (_col(c) - mean) / scale


def price_reached(share: float, amount="amount", model="model_price") -> Column:
    """Bid above ``share`` of a known, positive model price."""
    amount, model = _col(amount), _col(model)
    hit = (model > 0) & (amount > model * F.lit(float(share)))
    return F.coalesce(hit, F.lit(False)).cast("int")


def sigmoid(c) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(c)))


def round4(c) -> Column:
    return F.round(_col(c), 4)


def default_if_null(c, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))
