"""Rules on a text's words and lines, and a log-likelihood ratio of hashed n-grams.

Every document's n-grams (tokens and pairs of neighbours, hashed into
``BUCKETS``) are counted twice: over all documents (the raw corpus) and over
trusted ones (the target).  A text's score is the mean over its n-grams of
``log((t + KAPPA) / (e + KAPPA))``: t is the bucket's count among the trusted,
e the count to be expected there at the raw corpus' rate; both are multinomials
with the same pseudo count.  A text is kept when it passes the base rules and
its score reaches ``THRESHOLD``, so each decision depends on corpus counts only.

A token is a word, parted at each symbol of ``APART``, or such a symbol.  A pair has no
order and a token beside itself is one n-gram whatever the token is: stuttering
looks alike in every vocabulary.

JVM only.  One scan counts, with at most ``BUCKETS`` rows per task going into
the shuffle; the other scores each row where it is, without moving texts.  The
ratios are one array of ``BUCKETS`` numbers, whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import BLANK_CHARS, let, packed, words_of, written

BUCKETS = 1 << 14
KAPPA = 10.0
THRESHOLD = -0.15
SYMBOLS, APART = "[#*$%&|<>]", "([#*$%&|<>!])"
MIN_WORDS, MAX_REPEATED, WIDTH = 20, 30, 8


def _tail(a: Column, step: int) -> Column:
    return F.slice(a, F.lit(1 + step), F.greatest(F.size(a) - step, F.lit(0)))


def _pairs(a: Column, step: int) -> Column:
    """Element i with element i + step, hashed; the last ``step`` elements have no partner."""
    return F.zip_with(a, _tail(a, step), lambda x, y: F.xxhash64(x, y))


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows of ``WIDTH`` (8) words found twice or more.

    Windows are hashed by doubling (2, 4, 8 words).  Only texts in which two
    windows agree sort them; everything is linear or a sort inside the row.
    """
    def covered(windows):
        placed = F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))

        def again(s):
            def twin(x, k):
                return (F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))

            places = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
            return let(places, lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))),
                           lambda a, b: F.least(F.lit(WIDTH), F.coalesce(b - a, F.lit(WIDTH)))),
                F.lit(0).cast("long"), lambda total, x: total + x))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows),
                      F.lit(0).cast("long")).otherwise(let(F.sort_array(placed), again))

    eight = F.slice(
        let(_pairs(hashes, 1), lambda two: let(_pairs(two, 2), lambda four: _pairs(four, 4))),
        F.lit(1), F.greatest(F.size(hashes) - (WIDTH - 1), F.lit(0)))
    return F.when(F.size(hashes) > WIDTH, let(eight, covered)).otherwise(F.lit(0).cast("long"))


def token_hashes(text: Column) -> Column:
    """The hashes of a text's tokens; few texts hold a symbol to part words at."""
    apart = F.when(text.rlike(APART), F.regexp_replace(text, APART, " $1 ")).otherwise(text)
    return F.transform(words_of(apart), lambda w: F.xxhash64(w))


def _bucket(hash_: Column, buckets: int) -> Column:
    return F.pmod(hash_, F.lit(buckets)).cast("int")


def bucket_ratios(df: DataFrame, text: str, trusted: Column, buckets: int = BUCKETS,
                  kappa: float = KAPPA) -> DataFrame:
    """One row with ``ratios``, the log ratio of each bucket in order.

    ``trusted`` marks rows of the target (null: not).  Without n-grams or
    trusted rows every ratio is 0.
    """
    spark = df.sparkSession
    tokens = df.select(F.coalesce(trusted.cast("long"), F.lit(0)).alias("t"),
                       token_hashes(F.col(text)).alias("g"))
    pairs = F.zip_with("g", _tail(F.col("g"), 1), lambda x, y: x.bitwiseXOR(y))
    seen = tokens.select("t", F.explode(F.concat("g", pairs)).alias("g")).where(
        "g is not null").groupBy(_bucket(F.col("g"), buckets).alias("b")).agg(
        F.count("*").alias("raw"), F.sum("t").alias("trusted"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("b"),
                                        F.lit(0).cast("long").alias("raw"),
                                        F.lit(0).cast("long").alias("trusted"))
    counts = seen.unionByName(every).groupBy("b").agg(
        F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "trusted"))).alias("c"),
                        F.sum("raw").alias("n_raw"), F.sum("trusted").alias("n_trusted"))
    rate = F.coalesce(F.try_divide(F.col("n_trusted"), F.col("n_raw")), F.lit(0.0))
    return listed.select(F.when(F.col("n_trusted") > 0, F.transform("c", lambda x: F.log(
        (x["trusted"] + kappa) / (x["raw"] * rate + kappa)))).otherwise(
            F.array_repeat(F.lit(0.0), buckets)).alias("ratios"))


def trusted_documents(df: DataFrame, labels: DataFrame, text: str = "text",
                      key: str = "doc_id") -> DataFrame:
    """``text`` and ``trusted`` of every row: a label calls it good, none bad or toxic.

    Labels are grouped by key first, so repeated ones add no rows; a null key is
    trusted by nobody.  Texts move once; the labels' side of each partition is
    hashed, so texts are not sorted.
    """
    good = labels.groupBy(F.col(key).alias("_key")).agg(
        ((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("trusted"))
    good = good.where("trusted and _key is not null").hint("shuffle_hash")
    texts = df.select(df[f"`{key}`"].alias("_key"), df[f"`{text}`"].alias("text"))
    return texts.join(good, "_key", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))


def quality_rules(df: DataFrame, ratios: DataFrame, text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``df`` as the struct ``_row``, with the struct ``_quality``.

    ``ratios`` is the row of :func:`bucket_ratios`.  Fields: the five base
    measures, ``n_ngrams``, ``score`` (null without n-grams), ``base_failed``
    and ``kept``.  Null and empty texts have no words and fail; equal texts get
    equal results; repeated rows stay repeated; an empty table gives an empty one.
    """
    base = packed(df, text=text).select(
        "_row", F.coalesce("text", F.lit("")).alias("text"))
    grams = base.withColumns({"h": F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)),
                              "apart": F.col("text").rlike(APART)})
    grams = grams.withColumn("g", F.when(F.col("apart"), token_hashes(F.col("text"))).otherwise(F.col("h")))
    grams = grams.withColumn("ratios", ratios.select("ratios").scalar())
    m = F.size("g")

    def total(table):
        def of(x, y):
            pair = F.get(table, _bucket(x.bitwiseXOR(y), BUCKETS))
            return F.get(table, _bucket(x, BUCKETS)) + F.coalesce(pair, F.lit(0.0))

        return F.aggregate(F.zip_with("g", _tail(F.col("g"), 1), of), F.lit(0.0), lambda s, v: s + v)

    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANK_CHARS))) > 0)
    measures = {
        "n_words": F.size("h").cast("long"),
        "word_chars": (F.length("text") - F.regexp_count("text", F.lit("[\\x20\\x09-\\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(F.col("h")),
        "n_ngrams": F.greatest(2 * m - 1, F.lit(0)).cast("long"),
    }
    scored = grams.select("_row", *[c.alias(n) for n, c in measures.items()],
                          total(F.col("ratios")).alias("total"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    score = F.try_divide(F.col("total"), F.col("n_ngrams"))
    return scored.select("_row", F.struct(
        *measures, score.alias("score"), failed.alias("base_failed"),
        F.coalesce(~failed & (score >= threshold), F.lit(False)).alias("kept")).alias("_quality"))


def ratios_from_labels(df: DataFrame, labels: DataFrame, text: str = "text",
                       key: str = "doc_id") -> DataFrame:
    """:func:`bucket_ratios` of the trusted documents, written once to the shared folder."""
    marked = trusted_documents(df, labels, text, key)
    return written(bucket_ratios(marked, "text", F.col("trusted")), "quality-ratios")
