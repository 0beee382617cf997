"""Grouped prefix join: documents whose shingle sets have a Jaccard similarity of 0.8 or more.

1. ``sketches`` reads every text once: size and hash of its shingle set, and the
   set's prefix, its first ``n - ceil(0.8 n) + 1`` shingles in one global order.
   Two sets that link share a shingle of their prefixes, in any order.  The order
   puts shingles last that are frequent in one of ``SAMPLE`` documents (at most
   ``STOP`` of them, so their list may go to every task), then goes by hash.
   The sample decides how many candidates there are and never what is found.
2. Equal sets are one node, named by their smallest id.  Nodes with the same
   prefix and size are one group, and only groups have postings.
3. Shingles with the same list of groups are one.  Candidates come from these
   lists without all pairs: of the groups of a list two of different components are
   hubs, those in which the shingle stands earliest, and in each round the members
   of a group are verified against the first node of that hub of another component
   that most of its lists have.  Lists whose nodes
   are all in one component are done and drop out.  After ``ROUNDS`` rounds with
   other hubs, what is left is enumerated in full: group pairs of a list that
   pass the size filter, the position filter (two sets share no more than what
   stands in each from their first common shingle on) and the parity filter,
   expanded to members that are
   in different components yet.  So every pair that may link is verified, or its two
   nodes are known to be connected already.
4. A candidate pair is verified in three steps.  Two sets differ in at least as many
   shingles as their parity bits differ; what they share is at most
   what their prefixes share and one of their rests, so most pairs fall by bits and
   prefixes alone; the intersection of the two whole sets decides the others.
   Whole sets are made only of the nodes that get so far.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import dropped, written
from paddock.llm.components import components
from paddock.llm.shingles import lists_of, mix, shingles, texts_as_bytes

WIDTH, PERCENT = 5, 80
SAMPLE, FREQUENT, STOP = 16, 4, 200_000
ROUNDS = 3
#: Bits of the map of ids that tells most texts without a candidate apart; fixed, so it may go to every task.
ID_BITS = 1 << 23
#: Longs of parity bits that every set has.
PARITY = 8


def set_sizes_fit(a, b):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def positions_fit(n, p, other_n, other_p):
    """Whether sets of these sizes can link if their first common shingle stands at ``p`` and ``other_p``.

    They have to share ``PERCENT / (100 + PERCENT)`` of both sizes together.
    """
    least = PERCENT * (n + other_n)
    return ((100 + PERCENT) * (n - p) >= least) & ((100 + PERCENT) * (other_n - other_p) >= least)


def parity(s: np.ndarray) -> np.ndarray:
    """For each of ``64 * PARITY`` classes of shingles whether the set has an odd number of them.

    A bit that differs takes a shingle that only one of two sets has.
    """
    at = (mix(s.view(np.uint64) + np.uint64(3)) % np.uint64(64 * PARITY)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * PARITY) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def parities_fit(n, bits, other_n, other_bits):
    """Whether sets of these sizes may link: they differ in at least as many shingles as bits."""
    differ = sum((F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.get(other_bits, F.lit(i)))) for i in range(PARITY)),
                 F.lit(0))
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (n + other_n)


def shingle_sets(df: DataFrame) -> DataFrame:
    """``id`` and ``s``, the sorted distinct shingle hashes, for a frame of ``id`` and ``text``."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sets = [shingles(t, WIDTH) for t in texts_as_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), lists_of(sets)], ["id", "s"])

    return df.select("id", "text").mapInArrow(run, "id long, s array<long>")


def frequent_shingles(df: DataFrame) -> np.ndarray:
    """At most ``STOP`` shingles of several sampled documents, sorted."""
    sample = df.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    counts = shingle_sets(sample).select(F.explode("s").alias("s")).groupBy("s").count()
    top = counts.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "s").limit(STOP)
    return np.sort(np.array([r.s for r in top.select("s").collect()], np.int64))


def sketches(df: DataFrame, last: np.ndarray) -> DataFrame:
    """``id``, ``n``, two hashes of the set, a hash of its prefix, the prefix, and the set's parity bits."""
    shared = df.sparkSession.sparkContext.broadcast(last)

    def sketch(s):
        n, bits = len(s), parity(s)
        size = n - (n * PERCENT + 99) // 100 + 1 if n else 0
        stop = shared.value
        if len(stop) and n:
            at = np.minimum(np.searchsorted(stop, s), len(stop) - 1)
            s = np.concatenate([s[stop[at] != s], s[stop[at] == s]])
        prefix = s[:size]
        with np.errstate(over="ignore"):
            u, v = mix(s.view(np.uint64)), mix(prefix.view(np.uint64) + np.uint64(7))
            sums = (u.sum(dtype=np.uint64), mix(u + np.uint64(1)).sum(dtype=np.uint64), v.sum(dtype=np.uint64))
        return n, prefix, bits, [np.uint64(x).astype(np.int64) for x in sums]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [sketch(shingles(t, WIDTH)) for t in texts_as_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64())]
                + [pa.array([r[3][j] for r in rows], pa.int64()) for j in range(3)]
                + [lists_of([r[j] for r in rows]) for j in (1, 2)],
                ["id", "n", "k1", "k2", "pk", "prefix", "bits"])

    return df.select("id", "text").mapInArrow(
        run, "id long, n long, k1 long, k2 long, pk long, prefix array<long>, bits array<long>")


def _mask(bit):
    return F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is in ``ids`` (distinct); a bit map of fixed size spares most others the shuffle."""

    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(ID_BITS))

    words = ids.select(bit("id").alias("b")).groupBy((F.col("b") / 64).cast("int").alias("_word")).agg(
        F.bit_or(_mask(F.col("b"))).alias("_bits"))
    near = df.withColumn("_b", bit("id")).withColumn("_word", (F.col("_b") / 64).cast("int")).join(
        F.broadcast(words), "_word")
    return near.where(F.col("_bits").bitwiseAND(_mask(F.col("_b"))) != 0).drop("_b", "_word", "_bits").join(
        # not a semi join: that would be moved below the bit map, to all rows
        ids.hint("shuffle_hash"), "id")


def _enough(shared, a, b):
    return 100 * shared >= PERCENT * (a + b - shared)


def _both(pairs: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    """``pairs`` with the named values of both nodes."""
    for side in ("b", "a"):
        pairs = pairs.join(values.select(F.col("id").alias(side), *[
            F.col(n).alias(f"{n}_{side}") for n in names]), side)
    return pairs


class _Verifier:
    """Tells which pairs ``a``, ``b`` link; keeps the whole sets it has made."""

    def __init__(self, docs: DataFrame, prefixes: DataFrame):
        self.docs, self.prefixes = docs, prefixes
        self.sets: DataFrame | None = None
        self.made: list[DataFrame] = []

    def links(self, pairs: DataFrame) -> DataFrame:
        alike = _both(pairs, self.prefixes, "n", "bits").where(
            parities_fit(F.col("n_a"), F.col("bits_a"), F.col("n_b"), F.col("bits_b"))).select("a", "b")
        near = _both(alike, self.prefixes, "n", "prefix")
        rest = F.greatest(F.col("n_a") - F.size("prefix_a"), F.col("n_b") - F.size("prefix_b"))
        most = F.least(F.size(F.array_intersect("prefix_a", "prefix_b")) + rest, F.col("n_a"), F.col("n_b"))
        near = written(near.where(_enough(most, F.col("n_a"), F.col("n_b"))).select("a", "b"), "pairs")
        self._make(near.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        if self.sets is None:
            return near
        whole = _both(near, self.sets, "s")
        shared = F.size(F.array_intersect("s_a", "s_b"))
        found = written(whole.where(_enough(shared, F.size("s_a"), F.size("s_b"))).select("a", "b"), "links")
        dropped(near)
        return found

    def _make(self, ids: DataFrame) -> None:
        if self.sets is not None:
            ids = ids.join(self.sets.select("id"), "id", "left_anti")
        ids = written(ids, "ids")
        if not ids.isEmpty():
            new = written(shingle_sets(_only(self.docs, ids)), "sets")
            self.made.append(new)
            self.sets = new if self.sets is None else self.sets.union(new)
        dropped(ids)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component`` for every row of ``df``.

    The component is the smallest id reachable by links; equal texts always
    link.  A null, empty or blank text has no shingles and links with nothing.
    Rows without an id take part as a copy of others only (component null where
    no other row has the text); rows that share an id count as one document.
    Extra columns are not read, an empty table gives an empty one.
    """
    docs = df.select(df[f"`{key}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"))
    known = written(sketches(docs, frequent_shingles(docs)), "sketches")
    keys = ["n", "k1", "k2"]
    nodes = written(known.where("n > 0").groupBy(*keys, "pk").agg(F.min("id").alias("node"))
                    .where("node is not null"), "nodes")
    groups = nodes.groupBy("n", "pk").agg(F.min("node").alias("g"), F.count("*").alias("members"))
    members = written(nodes.join(groups, ["n", "pk"]).select("g", "node", "n", "members"), "members")
    heads = members.where("node = g").select(F.col("g").alias("id"), "members", "n").dropDuplicates(["id"])
    heads = written(known.join(heads.drop("n"), "id").select(
        F.col("id").alias("g"), "members", "n", "prefix"), "heads")
    found = _components_of(docs, known, members, _lists(_postings(heads)))
    dropped(heads)
    dropped(members)
    named = nodes.join(found, "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component"))
    out = known.select("id", *keys).join(named, keys, "left")
    return out.select("id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component"))


def _postings(heads: DataFrame) -> DataFrame:
    """``t``, ``g``, ``members``, ``n`` and place ``p`` of the prefix shingles that two nodes or more have.

    The shingles are counted alone first, so those of one node only (most of them) carry nothing through a shuffle.
    """
    counts = heads.select(F.explode("prefix").alias("t"), "members").groupBy("t").agg(F.sum("members").alias("m"))
    several = written(counts.where("m > 1").select("t"), "several")
    out = written(heads.select(F.posexplode("prefix").alias("p", "t"), "g", "members", "n").join(several, "t"),
                  "postings")
    dropped(several)
    return out


def _lists(postings: DataFrame) -> DataFrame:
    """``t``, ``g``, ``n``, ``p`` of the shingles with two nodes or more, one shingle per list of groups.

    Lists are told apart by number, two sums, least and largest of their groups' hashes.
    Of equal lists the shingle stays that stands first, in all its groups alike, as the
    order is one for all: a pair's first common shingle stands no earlier.
    """
    h = F.xxhash64("g")
    lists = postings.groupBy("t").agg(
        F.sum("members").alias("m"), F.count("*").alias("c"), F.min(h).alias("low"), F.max(h).alias("high"),
        F.sum(F.pmod(h, F.lit(1 << 30))).alias("s1"),
        F.sum(F.pmod(F.xxhash64("g", F.lit(1)), F.lit(1 << 30))).alias("s2"),
        F.min(F.struct(h, F.col("p"))).getField("p").alias("p")).where("m > 1")
    kept = lists.groupBy("c", "low", "high", "s1", "s2").agg(F.min(F.struct("p", "t")).getField("t").alias("t"))
    one = written(kept.select("t"), "shingles")
    out = written(postings.join(one, "t").select("t", "g", "n", "p"), "lists")
    dropped(postings, one)
    return out


def _hub(name: str = "hub") -> Column:
    """Of the groups of a list that have not been a hub the one in which its shingle stands earliest.

    What stands before the first common shingle is not shared, so no group can share
    more with the others: in a set of edited copies it is one with the fewest edits.
    """
    return F.min(F.struct(F.array_contains("tried", F.col("g")), (F.col("p") / F.col("n")).alias("place"),
                          F.xxhash64("g").alias("h"), "g", "n", "p", "low", "high")).alias(name)


def _apart(low, high, other_low, other_high) -> Column:
    """Whether two groups have nodes of two components; the least and largest of each are given."""
    return (low != other_high) | (high != other_low)


def _one_hub_each(lists: DataFrame) -> DataFrame:
    """``g`` and ``a``, the hub in another component that most of its lists have (one a
    round, so candidates are as many as groups), and itself where its members differ."""
    met = lists.select("g", "n", "p", "low", "high", F.explode(F.array("hub", "other")).alias("hub")).where(
        "hub is not null")
    fit = met.where((F.col("g") != F.col("hub.g")) & set_sizes_fit(F.col("n"), F.col("hub.n"))
                    & positions_fit(F.col("n"), F.col("p"), F.col("hub.n"), F.col("hub.p"))
                    & _apart(F.col("low"), F.col("high"), F.col("hub.low"), F.col("hub.high")))
    votes = fit.groupBy("g", F.col("hub.g").alias("a")).agg(
        F.count("*").alias("lists"), F.min("hub.place").alias("place"), F.min("hub.h").alias("h"))
    best = votes.groupBy("g").agg(F.max(F.struct("lists", -F.col("place"), "h", "a")).alias("best"))
    own = lists.where("low < high").select("g", F.col("g").alias("a")).distinct()
    return best.select("g", F.col("best.a").alias("a")).union(own)


def _components_of(docs: DataFrame, known: DataFrame, members: DataFrame, lists: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the nodes that link."""
    spark = docs.sparkSession
    nodes = written(members.join(lists.select("g").distinct(), "g", "left_semi"), "nodes-near")
    ids = nodes.select(F.col("node").alias("id")).distinct()
    prefixes = written(known.select("id", "n", "prefix", "bits").join(ids, "id", "left_semi"), "prefixes")
    verifier = _Verifier(docs, prefixes)
    links, found = spark.createDataFrame([], "a long, b long"), []
    labels = spark.createDataFrame([], "node long, component long")
    lists = lists.withColumn("tried", F.array().cast("array<long>"))
    for turn in range(ROUNDS + 1):
        held = written(nodes.join(labels, "node", "left").select(
            "g", "node", "n", F.coalesce("component", "node").alias("c")), "labelled")
        spans = held.groupBy("g").agg(F.min("c").alias("low"), F.max("c").alias("high"))
        seen = lists.select("t", "g", "n", "p", "tried").join(spans, "g")
        whole = seen.groupBy("t").agg(_hub(), F.min("low").alias("least"), F.max("high").alias("most"))
        whole = written(whole.where("least < most").select("t", "hub"), "hubs")
        apart = _apart(F.col("low"), F.col("high"), F.col("hub.low"), F.col("hub.high"))
        other = seen.join(whole, "t").where(apart).groupBy("t").agg(_hub("other"))
        hubs = whole.join(other, "t", "left")
        before, lists = lists, written(seen.join(hubs, "t").withColumn(
            "tried", F.concat("tried", F.array("hub.g", "other.g"))), "lists")
        dropped(whole)
        dropped(before)
        last = lists
        if lists.isEmpty():
            dropped(held)
            break
        if turn < ROUNDS:
            groups = _one_hub_each(lists)
            heads = held.where("node = g").select(F.col("node").alias("a"), F.col("c").alias("ca")).distinct()
            pairs = groups.join(held.select("g", F.col("node").alias("b"), "c"), "g").join(heads, "a").where(
                "a != b and c != ca").select("a", "b")
        else:
            # the bits of groups of one node; in larger ones the members are told apart later
            bits = held.join(prefixes.select(F.col("id").alias("node"), "bits"), "node").groupBy("g").agg(
                F.when(F.count("*") == 1, F.max("bits")).alias("bits"))
            lists = lists.drop("hub", "other", "tried").join(bits, "g", "left")
            other = lists.select("t", F.col("bits").alias("bits2"), F.col("g").alias("g2"), F.col("n").alias("n2"), F.col("p").alias("p2"),
                                 F.col("low").alias("low2"), F.col("high").alias("high2"))
            groups = lists.join(other, "t").where(
                (F.col("g") <= F.col("g2")) & set_sizes_fit(F.col("n"), F.col("n2"))
                & positions_fit(F.col("n"), F.col("p"), F.col("n2"), F.col("p2"))
                & _apart(F.col("low"), F.col("high"), F.col("low2"), F.col("high2"))
                & F.coalesce(parities_fit(F.col("n"), F.col("bits"), F.col("n2"), F.col("bits2")), F.lit(True))
            ).select("g", "g2").distinct()
            one = held.select("g", F.col("node").alias("a"), F.col("c").alias("ca"))
            two = held.select(F.col("g").alias("g2"), F.col("node").alias("b"), F.col("c").alias("cb"))
            pairs = groups.join(one, "g").join(two, "g2").where("a != b and ca != cb").select(
                F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = verifier.links(pairs)
        dropped(held)
        if not new.isEmpty():
            links = links.union(new)
            found.append(new)
            before, labels = labels, components(links)
            dropped(before)
    # what is returned reads the labels alone
    dropped(last, nodes, prefixes, *found, *verifier.made)
    return labels
