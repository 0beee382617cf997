"""Order over the whole data without one task that holds it.

``running_total`` sorts by ranges, writes the sorted parts once (so the part
numbers stay what they are when a task is repeated), adds up each part, and
shifts every part by the sum of those before it.  The time split needs no such order:
its cuts are found by counting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.session import cut


def running_total(df: DataFrame, order, weights, by=()) -> DataFrame:
    """Add ``cum_<w>``: the sum of ``w`` over earlier rows and this one, per ``by``.

    ``order`` must be unique within ``by`` (count equal rows first): then a hot
    group or value spreads over as many ranges as its size asks for.
    """
    order, by, weights = list(order), list(by), list(weights)
    part = cut(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    sums = part.groupBy("_part", *by).agg(*[F.sum(w).alias(f"_s_{w}") for w in weights])
    # Only a group that began in an earlier part inherits anything, and a part
    # can only continue one: at most one row per part is left to hand on.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        "_part", *by, *[F.sum(f"_s_{w}").over(before).alias(f"_c_{w}") for w in weights]
    ).where(reduce(lambda a, b: a | b, [F.col(f"_c_{w}").isNotNull() for w in weights]))
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    out = part.select("*", *[F.sum(w).over(inside).alias(f"_i_{w}") for w in weights])
    carry = carry.withColumnsRenamed({c: f"_k_{c}" for c in ["_part", *by]})
    same = reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ["_part", *by]])
    out = out.join(F.broadcast(carry), same, "left")
    return out.select(
        *df.columns,
        *[(F.col(f"_i_{w}") + F.coalesce(F.col(f"_c_{w}"), F.lit(0))).alias(f"cum_{w}")
          for w in weights],
    )


def global_index(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """0-based position of every row in ``order``; equal rows get any order."""
    # the draw breaks ties so that copies of one row spread over ranges too
    drawn = df.withColumn("_one", F.lit(1).cast("bigint")).withColumn("_tie", F.rand(7))
    out = running_total(drawn, [*order, "_tie"], ["_one"])
    return out.withColumn(name, F.col("cum__one") - 1).drop("cum__one", "_one", "_tie")


def _tuple_before(keys, point) -> Column:
    """Lexicographic (keys) < (point), nulls first as in sorting."""
    out = F.lit(False)
    for c in reversed(keys):
        here = F.lit(point[c])
        less = F.lit(False) if point[c] is None else F.col(c).isNull() | (F.col(c) < here)
        out = F.coalesce(less, F.lit(False)) | (F.col(c).eqNullSafe(here) & out)
    return out


def _tuple_equal(keys, point) -> Column:
    out = F.lit(True)
    for c in keys:
        out = out & F.col(c).eqNullSafe(F.lit(point[c]))
    return out


#: Error of a sketch of seconds as one in so many, and what is added to either side of a cut.
ACCURACY, SLACK = 10_000, 4 / 10_000
#: Below and above all seconds.
FIRST, LAST = -(1 << 63), (1 << 63) - 1
#: The seconds around a cut are listed; a second with more rows than this is narrowed first.
LISTED = 1_000_000
#: Key tuples that narrow a second at once.
SPLITTERS = 64


def _seconds_at(df: DataFrame, ts: str, positions, points) -> dict:
    """{position: (second, rows before it, rows in it)}, all positions in one scan.

    ``points`` enclose each position by a sketch; where one did not, all seconds
    are counted.
    """
    found, asked = {}, [(p, low, high) for p, (low, high) in zip(positions, points)]
    while asked:
        bounds = F.explode(F.array(*[F.struct(F.lit(p).alias("at"), F.lit(low).alias("low"), F.lit(high).alias("high"))
                                     for p, low, high in asked]))
        key = F.when(F.col("t") >= F.col("b.low"), F.col("t"))
        counted = df.select(F.col(ts).alias("t"), bounds.alias("b")).where("t <= b.high").groupBy(
            F.col("b.at").alias("at"), key.alias("second")).agg(F.count("*").alias("cnt"))
        # a row per distinct second between the bounds
        upto = Window.partitionBy("at").orderBy(F.col("second").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, 0)
        rows = counted.withColumn("cum", F.sum("cnt").over(upto)).where("cum > at and cum - cnt <= at").collect()
        found |= {r["at"]: (r["second"], r["cum"] - r["cnt"], r["cnt"]) for r in rows if r["second"] is not None}
        asked = [(p, FIRST, LAST) for p, _, _ in asked if p not in found]
    return found


def _splitters(df: DataFrame, keys, rows: int) -> list[dict]:
    """Some distinct key tuples of ``df`` in order: a share of all by hash, whatever their copies."""
    share = max(1, rows // (8 * SPLITTERS))
    while True:
        some = df if share == 1 else df.where(F.pmod(F.xxhash64(*keys), F.lit(share)) == 0)
        found = some.select(*keys).distinct().orderBy(*keys).limit(64 * SPLITTERS).collect()
        if found or share == 1:
            step = max(1, len(found) // SPLITTERS)
            return [r.asDict() for r in found[::step]]
        share = max(1, share // 16)


def _narrowed(df: DataFrame, ties, at: int, rows: int) -> tuple[DataFrame, int]:
    """The rows between two key tuples around position ``at``, and the position among them."""
    while rows > LISTED:
        keys = _splitters(df, ties, rows)
        # how many of them are not above a row's own
        place = sum([(~_tuple_before(ties, k)).cast("int") for k in keys], F.lit(0))
        counts = {r["b"]: r["c"] for r in df.groupBy(place.alias("b")).agg(F.count("*").alias("c")).collect()}
        before, b = 0, 0
        while before + counts.get(b, 0) <= at:
            before, b = before + counts.get(b, 0), b + 1
        if counts[b] == rows:
            break  # nothing between the splitters parts them: few different keys
        if b:
            df = df.where(~_tuple_before(ties, keys[b - 1]))
        if b < len(keys):
            df = df.where(_tuple_before(ties, keys[b]))
        at, rows = at - before, counts[b]
    return df, at


def _cut_points(df: DataFrame, ts: str, ties, positions, points) -> list[dict]:
    """The key tuple at each 0-based position, with the copies left of it.

    The second that holds each position comes from counts per second, the key from
    counts per key in those seconds; one scan each for all positions.  Only a second
    that holds very many rows is narrowed first.
    """
    keys = [ts, *ties]
    seconds = _seconds_at(df, ts, positions, points)
    parts = None
    for p, (second, before, rows) in seconds.items():
        inside, at = _narrowed(df.where(F.col(ts) == F.lit(second)), ties, p - before, rows)
        inside = inside.select(*keys, F.lit(p).alias("_at"), F.lit(at).alias("_in"))
        parts = inside if parts is None else parts.unionByName(inside)
    counted = parts.groupBy("_at", "_in", *keys).agg(F.count("*").alias("cnt"))
    upto = Window.partitionBy("_at", "_in").orderBy(*ties).rowsBetween(Window.unboundedPreceding, 0)
    rows = counted.withColumn("cum", F.sum("cnt").over(upto)).where("cum > _in and cum - cnt <= _in").collect()
    found = {r["_at"]: r for r in rows}
    return [{"key": {c: found[p][c] for c in keys}, "copies": found[p]["cnt"],
             "left": found[p]["_in"] - (found[p]["cum"] - found[p]["cnt"])} for p in positions]


def time_split(df: DataFrame, shares=(0.8, 0.1, 0.1), ts: str = "ts",
               ties=("user_id", "clue_id", "recommend_id"),
               names=("train", "valid", "test")) -> DataFrame:
    """Add ``split``: rows in time order cut at int(0.8 n) and int(0.9 n).

    All cuts are found together, by three scans of the keys: a sketch of the seconds,
    counts of the seconds around each cut, counts of the keys in those.  The rows
    themselves are labelled by comparison with the keys at the cuts and do not move.
    Null seconds and null ties come first.
    """
    keys = [ts, *ties]
    totals = [round(sum(shares[:k + 1]), 10) for k in range(len(shares) - 1)]
    near = [min(1.0, max(0.0, t + d)) for t in totals for d in (-SLACK, SLACK)]
    order = df.select(F.coalesce(F.col(ts).cast("long"), F.lit(FIRST)).alias("_t"), *keys)
    first = order.agg(F.count("*").alias("n"), F.percentile_approx("_t", near, ACCURACY).alias("q")).first()
    n = first["n"]
    bounds = [int(n * t) for t in totals]
    enclosed = {b: first["q"][2 * k:2 * k + 2] for k, b in enumerate(bounds) if b < n}
    todo = sorted(enclosed)
    found = _cut_points(order, "_t", list(ties), todo, [enclosed[b] for b in todo]) if todo else []
    points = {b: p | {"key": {ts: None if p["key"]["_t"] == FIRST else p["key"]["_t"],
                              **{c: p["key"][c] for c in ties}}} for b, p in zip(todo, found)}

    label = None
    torn = {}
    for b, name in zip(bounds, names):
        if b >= n:
            cond = F.lit(True)
        else:
            cond = _tuple_before(keys, points[b]["key"])
            if points[b]["left"]:
                torn.setdefault(tuple(points[b]["key"].values()), points[b]["key"])
        label = F.when(cond, name) if label is None else label.when(cond, name)
    label = label.otherwise(names[-1])
    out = df.withColumn("split", label)
    # copies of one key on both sides of a cut: number those rows and share them out
    for key in torn.values():
        same = _tuple_equal(keys, key)
        numbered = global_index(df.where(same), keys, "_i")
        share = None
        for b, name in zip(bounds, names):
            if b >= n:
                left = F.lit(True)
            elif points[b]["key"] == key:
                left = F.col("_i") < points[b]["left"]
            else:
                left = _tuple_before(keys, points[b]["key"])
            share = F.when(left, name) if share is None else share.when(left, name)
        shared = numbered.withColumn("split", share.otherwise(names[-1])).drop("_i")
        out = out.where(~same).unionByName(shared)
    return out


def shuffle_rows(df: DataFrame, seed: int = 0) -> DataFrame:
    """Random row order, reproducible for the same input order."""
    return df.orderBy(F.rand(seed))
