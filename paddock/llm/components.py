"""Connected components of an edge table, by rounds of joins on small rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import dropped, written


def _stars(links: DataFrame) -> bool:
    """Whether the links, each from ``u`` to a smaller ``v``, form stars: the next round would change none."""
    ends = links.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("v", F.lit(0), F.lit(1)))
    roles = ends.groupBy("u").agg((F.sum("up") + F.max("down")).alias("roles"))
    return (roles.agg(F.max("roles")).first()[0] or 0) <= 1


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of an edge.

    Each round every node links all its neighbours to the smallest of them (with
    itself); first only the larger ones, then only the smaller ones, until the
    links form stars: every node has one link, or is the smaller end of all its
    links.  Links stay as many as there were at most, and each round is written
    to the shared folder.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
    links = written(links.distinct(), "components")
    while not _stars(links):
        both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: every node with its smaller neighbours
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        before, links = links, written(small.where("u != v").distinct(), "components")
        dropped(before)
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out._scratch = links._scratch  # so that who replaces the result can drop it
    return out
