"""Delete runs of lines that repeat an earlier run, found by winnowing over line hashes.

The lines of a text that hold a word, without blanks at their ends, are a
sequence of hashes.  A window starts at every line and is the shortest run from
there with ``LONG`` words or ``LINES`` lines; its fingerprint is the place of its
smallest line hash, so neighbouring windows mostly share one.  Any repeated run
of ``LINES`` lines or ``LONG`` words holds a whole window and so shares a
fingerprint and the window with its first copy: that much is guaranteed to go.

Fingerprints seen once drop out.  The windows of the others, and each of them
with its next lines up to ``LINES`` in all, are runs that are joined to their own
first place in the corpus (by document, then line); a run of a later place is
deleted.  So a run that later copies share goes even where the first copy of its
window goes on differently.  Longer runs need no row: they hold the window of the
next line as well.  To the left nothing needs to be compared: every window that
starts inside a repeated run and before its last whole window is a repeated window
itself.  Every deleted line equals an earlier line that stays, and a place is at
most ``LINES`` hashes, so no pairs of copies are made.

JVM only.  Rows agreeing in key and text are one document and get one result;
documents are ordered by key (null first), then by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import BLANK_CHARS, let, packed, written

LINES, LONG = 4, 50


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK_CHARS))


def _windows(h: Column, n: Column) -> Column:
    """The windows of one text; ``h`` and ``n`` hold hash and words of each line."""

    def at(i):
        words = [F.coalesce(F.get(n, i + j), F.lit(0)) for j in range(LINES)]
        total = words[0]
        size = F.when(total >= LONG, 1)
        for j in range(1, LINES):
            total = total + words[j]
            size = size.when((total >= LONG) & (i + j < F.size(h)), j + 1)
        size = size.when(i + LINES <= F.size(h), LINES)

        def full(k):
            return let(F.slice(h, i + 1, k), lambda s: F.struct(
                i.alias("i"), k.alias("k"),
                (i + F.array_position(s, F.array_min(s)).cast("int") - 1).alias("place"),
                F.array_min(s).alias("print"),
                F.transform(F.sequence(k, F.least(F.lit(LINES), F.size(h) - i)),
                            lambda m: F.xxhash64(F.slice(h, i + 1, m))).alias("runs")))

        return F.when(size.isNotNull(), full(size))

    every = F.transform(F.sequence(F.lit(0), F.size(h) - 1), at)
    return F.when(F.size(h) > 0, F.filter(every, lambda w: w.isNotNull()))


def line_windows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per window of every different document: ``doc``, ``i``, ``k``,
    ``place``, ``print`` and ``runs``, the hashes of its lines and of those with the next 1, 2 ... lines."""
    docs = df.select(_document(df, key, text), df[f"`{text}`"].alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), _trim), lambda x: F.length(x) > 0)
    # bound inside one expression: a lambda that reads another column would have
    # that column's expression computed again for every line
    hashed = let(lines, lambda ls: F.struct(
        F.transform(ls, lambda x: F.xxhash64(x)).alias("h"),
        F.transform(ls, lambda x: F.regexp_count(x, F.lit("[^\\x20\\x09-\\x0D]+"))).alias("n")))
    windows = let(hashed, lambda s: _windows(s["h"], s["n"]))
    # outer: no filter on the windows is inferred, which would compute them twice
    listed = docs.select("doc", F.explode_outer(windows).alias("w")).where("w is not null")
    return listed.select("doc", "w.*")


def _document(df: DataFrame, key: str, text: str) -> Column:
    t = df[f"`{text}`"]
    return F.struct(df[f"`{key}`"].alias("key"), F.xxhash64(t).alias("hash")).alias("doc")


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` and ``gone``, the numbers of its lines (with a word, from 0) that repeat earlier ones."""
    windows = written(line_windows(df, key, text), "line-windows")
    prints = windows.select("doc", "place", "print").distinct()
    repeated = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    kept = windows.join(written(repeated, "line-prints"), "print", "left_semi")
    runs = kept.select("doc", "i", "k", F.posexplode("runs").alias("more", "run"))
    first = written(runs.groupBy("run").agg(
        F.min(F.struct("doc", "i")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("run", "first"), "line-firsts")
    later = runs.join(first, "run").where(F.struct("doc", "i") > F.col("first"))
    # where a longer run is repeated its beginnings are too: each adds its last line
    last = (F.col("i") + F.col("k") + F.col("more") - 1).cast("int")
    ends = later.select("doc", F.when(F.col("more") == 0, F.col("i")).otherwise(last).alias("i"),
                        last.alias("last"))
    return ends.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list(
        F.sequence("i", "last")))).alias("gone"))


def _lines_left(text: Column, gone: Column) -> Column:
    """The text without the lines ``gone`` counts among those with a word."""

    def left(lines):
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        worded = F.filter(numbers, lambda i: F.length(_trim(F.get(lines, i))) > 0)
        drop = let(worded, lambda w: F.transform(gone, lambda g: F.get(w, g)))
        return F.array_join(F.transform(F.array_except(numbers, drop),
                                        lambda i: F.get(lines, i)), "\n")

    return let(F.split(text, "\n"), left)


def line_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``df`` as ``_row``, with the struct ``_lines``: ``text`` (what is
    left), ``n_lines``, ``n_deleted`` (of lines with a word) and ``emptied``.

    A null text stays null and an empty one empty, both with no lines; blank
    lines stay; repeated rows get equal results; an empty table gives an empty
    one.  Texts move once, unsorted, beside the line numbers to delete.
    """
    gone = repeated_lines(df, key, text).withColumnRenamed("doc", "_doc").hint("shuffle_hash")
    base = packed(df, text=text).withColumn("_doc", F.struct(
        F.col(f"_row.`{key}`").alias("key"), F.xxhash64("text").alias("hash")))
    # null keys are equal here, as in grouping
    on = (base["_doc.hash"] == gone["_doc.hash"]) & base["_doc.key"].eqNullSafe(gone["_doc.key"])
    both = base.join(gone, on, "left")
    worded = F.size(F.filter(F.split("text", "\n"), lambda x: F.length(_trim(x)) > 0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(worded)
    n_deleted = F.coalesce(F.size("gone"), F.lit(0))
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        _lines_left(F.col("text"), F.col("gone")))
    return both.select("_row", F.struct(
        left.alias("text"), n_lines.alias("n_lines"), n_deleted.alias("n_deleted"),
        ((n_deleted > 0) & (n_deleted == n_lines)).alias("emptied")).alias("_lines"))
