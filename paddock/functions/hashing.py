"""Reproducible draws: the same keys and seed give the same number anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["hash32", "unit_draw", "keep_draw"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash32(seed, *keys) -> Column:
    """Integer in [0, 2**32) from the md5 of ``seed|key|key...``.

    md5 and not ``rand``: a lost task that runs again must draw the same
    number, and plain SQL can repeat it.
    """
    parts = [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_draw(seed, *keys) -> Column:
    """Uniform double in (0, 1]."""
    return (hash32(seed, *keys) + F.lit(1)).cast("double") / F.lit(float(2**32))


def keep_draw(p: float, seed, *keys) -> Column:
    """True with probability ``p``; one draw per distinct key tuple."""
    return unit_draw(seed, *keys) <= F.lit(float(p))
