"""Mix sources to target weights by raking, then sample documents by calibrated probabilities.

Tokens are counted per cell (source, language, topic).  Iterative proportional
fitting multiplies the cells by one factor per source, language and topic until
their sums meet the three target marginals; each sweep is three small grouped
sums, written to the shared folder.  A document's probability is proportional to
its cell's raked weight per token, scaled so that the expected number of tokens
is the budget; probabilities that would pass 1 are set to 1 and the others
scaled again.  A document is taken if a hash of its id lies below it, so a task
that runs again takes the same ones.

Only cells, never documents, are grouped or joined: their number depends on the
categories.  Sums per cell start inside each task, so a source with a third of
all rows is one row per task.  Texts do not move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import let, packed, words_of, written

MARGINS = ("source", "lang", "topic")
TOPICS = 8
#: A marginal's default target: its share to this power, so large ones shrink and small ones grow.
POWER = 0.5
#: The part of all tokens to take.
BUDGET = 0.8
SWEEPS, CLOSE = 20, 1e-6


def topic_of(words: Column, topics: int = TOPICS) -> Column:
    """The topic with most of a text's words of six letters or more, each word's by its hash.

    Ties go to the smaller number; a text without such words has topic 0.
    """
    long = F.filter(words, lambda w: F.length(w) >= 6)
    hashes = F.transform(long, lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(topics)).cast("int"))

    def most(h):
        counts = F.array(*[F.size(F.filter(h, lambda x, t=t: x == t)) for t in range(topics)])
        return let(counts, lambda c: F.array_position(c, F.array_max(c)).cast("int") - 1)

    return let(hashes, most)


def marked(df: DataFrame, text: str = "text", source: Column | None = None,
           lang: Column | None = None, topic: Column | None = None) -> DataFrame:
    """``_row`` with its three categories, ``tokens`` and ``u``, a draw from [0, 1) by id and text."""
    key = df["`doc_id`"] if "doc_id" in df.columns else F.lit(None)
    base = packed(df, source=df["`source`"] if source is None else source,
                  lang=df["`lang`"] if lang is None else lang,
                  topic=F.lit(None) if topic is None else topic, words=words_of(df[f"`{text}`"]),
                  h=F.xxhash64(key.cast("string"), df[f"`{text}`"], F.lit("mixing")))
    return base.select(
        "_row", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")).alias(c) for c in ("source", "lang")],
        (topic_of(F.col("words")) if topic is None else F.col("topic")).cast("string").alias("topic"),
        F.size("words").cast("long").alias("tokens"),
        (F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))).alias("u"))


def tempered(cells: DataFrame, margin: str, power: float = POWER) -> DataFrame:
    """``value`` and ``goal``: each category's tokens to the ``power``, scaled to sum to 1."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("n"))
    whole = sums.agg(F.sum(F.pow("n", F.lit(power)))).scalar()
    return sums.select("value", F.try_divide(F.pow("n", F.lit(power)), whole).alias("goal"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` with ``w``: their tokens, raked to the targets' shares of all tokens.

    A target names ``value`` and ``goal``; a category without a goal gets 0.
    Sweeps end when no cell changes by more than ``CLOSE`` of itself, or after
    ``SWEEPS`` (marginals that no weights can meet together).
    """
    goals = {m: written(t, "goals") for m, t in targets.items()}
    now = written(cells.withColumn("w", F.col("tokens").cast("double")), "raked")
    whole = now.agg(F.sum("tokens")).first()[0] or 0
    for _ in range(SWEEPS):
        new = now.withColumn("before", F.col("w"))
        for m, goal in goals.items():
            factor = new.groupBy(m).agg(F.sum("w").alias("_sum")).join(
                goal.withColumnRenamed("value", m), m, "left").select(m, F.coalesce(F.try_divide(
                    F.col("goal") * F.lit(float(whole)), F.col("_sum")), F.lit(0.0)).alias("_f"))
            new = new.join(factor, m).withColumn("w", F.col("w") * F.col("_f")).drop("_f")
        new = written(new, "raked")
        moved = new.agg(F.max(F.try_divide(F.abs(F.col("w") - F.col("before")), F.col("w")))).first()[0]
        now = new.drop("before")
        if moved is None or moved < CLOSE:
            break
    return now


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``raked`` with ``probability``, such that the expected tokens are ``budget`` of all.

    Cells at 1 stay there while the others are scaled again, until none passes 1;
    if the cells with weight hold fewer tokens than the budget all of them are at 1.
    """
    rate = F.try_divide(F.col("w"), F.col("tokens"))
    whole = raked.agg(F.sum("tokens")).first()[0] or 0
    scale, full = 0.0, None
    while True:
        at_one = F.coalesce(rate * F.lit(scale) >= 1, F.lit(False))
        n, tokens, rest = raked.agg(
            F.count_if(at_one), F.coalesce(F.sum(F.when(at_one, F.col("tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~at_one, F.col("w"))), F.lit(0.0))).first()
        if n == full or rest <= 0:
            break
        full, scale = n, max(budget * whole - tokens, 0.0) / rest
    return raked.withColumn("probability", F.coalesce(F.least(rate * F.lit(scale), F.lit(1.0)), F.lit(1.0)))


def mix(df: DataFrame, text: str = "text", budget: float = BUDGET,
        targets: dict[str, DataFrame] | None = None, **categories: Column) -> DataFrame:
    """Every row of ``df`` as ``_row``, with the struct ``_mix``: ``source``,
    ``lang``, ``topic``, ``tokens``, ``weight`` (raked weight per token),
    ``probability`` and ``taken``.

    A null category counts as the category "(null)"; a null or empty text has no
    tokens, weighs nothing in the counts and shares its cell's probability (1 in
    a cell without tokens).  Equal rows are taken or left together; an empty
    table gives an empty one.
    """
    rows = marked(df, text, **categories)
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    goals = {m: (targets or {}).get(m, tempered(cells, m)) for m in MARGINS}
    rates = written(probabilities(rake(cells, goals), budget).select(
        *MARGINS, F.try_divide(F.col("w"), F.col("tokens")).alias("weight"), "probability"), "rates")
    both = rows.join(rates, list(MARGINS), "left")
    return both.select("_row", F.struct(
        *MARGINS, "tokens", "weight", "probability",
        (F.col("u") < F.col("probability")).alias("taken")).alias("_mix"))
