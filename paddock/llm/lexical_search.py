"""The k best documents of every item of a query table, ranked by weighted terms.

Items are taken in blocks of bounded text.  For a block, every whole text becomes a
narrow row: its number of terms, and counts of the terms that the block's items
hold; the rest of the text plays no part in their scores.  Those rows are written
to the shared folder, give the counts over all documents, and are searched by dual
trees, task by task, with at most k rows per item coming out of each.

Documents chosen by a hash of their id are searched first.  The k-th score among
them is a floor for all: it changes no result, only how much the trees leave out
and how few rows leave a task.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import written
from paddock.llm.impact_trees import CHUNK, NO_ID, Best, ItemTrees, search_chunk

#: Characters of item text in a block; what is broadcast and collected grows with it alone.
BLOCK_CHARS = 2 << 20
#: One in so many documents is searched for the floor.
FLOOR_SHARE = 32
#: Bytes of a text that are split at once.
SLICE = 1 << 22

#: Letters of any script and digits stay, A to Z in lower case; all other ASCII parts terms.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def terms_of(text: bytes):
    """The terms of a text in lists of bounded length."""
    text, low = text.translate(_LOWER), 0
    while low < len(text):
        high = low + SLICE
        if high < len(text):
            # a slice ends where a term ends, however long that term is
            end = text.rfind(b" ", low, high)
            high = end if end > low else text.find(b" ", high)
            high = len(text) if high < 0 else high
        yield text[low:high].split()
        low = high


def floor_div(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """(75 * n * documents) div terms, also where the product exceeds 64 bits."""
    if len(n) and 75 * int(n.max()) * documents >= 2**63:
        return np.array([75 * int(x) * documents // terms for x in n], np.int64)
    return 75 * n * documents // terms


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term counts in a document: (1000000000 tf) div (1000 tf + 8 m), below a million."""
    m = 100 - 75 + floor_div(n, documents, terms)
    return 1000000000 * tf // (1000 * tf + 8 * m)


#: No impact exceeds it.
BEST_IMPACT = 10**6


class Items:
    """The items of a block: terms with their counts, and the block's vocabulary."""

    def __init__(self, texts: list):
        found = []
        for text in texts:
            counts: dict = {}
            for words in terms_of((text or "").encode("utf-8", "surrogatepass")):
                for w in words:
                    counts[w] = counts.get(w, 0) + 1
            found.append(counts)
        self.vocabulary = {w: i for i, w in enumerate(sorted(set().union(*found)))}
        #: places of the items that have terms
        self.places = [i for i, counts in enumerate(found) if counts]
        self.vectors = []
        for i in self.places:
            ids = np.array([self.vocabulary[w] for w in found[i]], np.int64)
            order = np.argsort(ids)
            self.vectors.append((ids[order], np.array(list(found[i].values()), np.int64)[order]))


def term_rows(docs: DataFrame, vocabulary, id: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term; the lists hold vocabulary terms only."""
    def run(batches):
        import pyarrow as pa

        get = vocabulary.value.get
        for b in batches:
            out = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                n, found = 0, {}
                for words in terms_of(t or b""):
                    n += len(words)
                    for w in map(get, words):
                        if w is not None:
                            found[w] = found.get(w, 0) + 1
                if n:
                    ids = sorted(found)
                    out.append((doc, n, ids, [found[i] for i in ids]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.list_(pa.int32())),
                 pa.array([x[3] for x in out], pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])

    rows = docs.select(docs[f"`{id}`"].cast("long").alias("id"), docs[f"`{text}`"].cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def term_counts(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and documents per vocabulary term."""
    def run(batches):
        import pyarrow as pa

        seen, documents, terms = np.zeros(size, np.int64), 0, 0
        for b in batches:
            documents += len(b)
            terms += int(b.column(0).to_numpy(zero_copy_only=False).sum())
            seen += np.bincount(b.column(1).flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([documents, terms, *seen[at].tolist()], pa.int64())],
            ["term", "c"])

    found = rows.select("n", "terms").mapInArrow(run, "term long, c long").groupBy("term").agg(F.sum("c").alias("c"))
    counts = {r.term: r.c for r in found.collect()}  # one row per term of the block
    df = np.array([counts.get(i, 0) for i in range(size)], np.int64)
    return counts.get(-2, 0), counts.get(-1, 0), df


def weights_of(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _searched(rows: DataFrame, shared, k: int) -> DataFrame:
    """(item, id, score): at most k rows per item from each task."""
    def run(batches):
        import pyarrow as pa

        vectors, documents, terms, floor = shared.value
        trees = ItemTrees(vectors, BEST_IMPACT)
        best = Best(len(vectors), k, floor)
        for b in batches:
            missing = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = np.where(missing, NO_ID, b.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            n = b.column(1).to_numpy(zero_copy_only=False)
            for low in range(0, len(b), CHUNK):
                lists = b.column(2).slice(low, CHUNK)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(lengths)), lengths)
                tf = b.column(3).slice(low, CHUNK).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                impact = impacts_of(tf, n[low:low + CHUNK][row], documents, terms)
                search_chunk(trees, best, row, term, impact, ids[low:low + CHUNK])
        item, at = np.nonzero(best.scores)
        found = best.ids[item, at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(found, pa.int64(), mask=found == NO_ID),
             pa.array(best.scores[item, at], pa.int64())], ["item", "id", "score"])

    return rows.select("id", "n", "terms", "tfs").mapInArrow(run, "item long, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _block(spark, docs: DataFrame, items: DataFrame, k: int, id: str, text: str) -> DataFrame | None:
    rows = items.collect()  # bounded: a block's items
    block = Items([r.text for r in rows])
    if not block.vectors:
        return None
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    vectors = written(term_rows(docs, vocabulary, id, text), "term-rows")
    documents, terms, df = term_counts(vectors, len(block.vocabulary))
    weights = weights_of(df, documents)
    weighted = [(ids, counts * weights[ids]) for ids, counts in block.vectors]

    def search(part: DataFrame, floor) -> DataFrame:
        return _ranked(_searched(part, spark.sparkContext.broadcast((weighted, documents, terms, floor)), k), k)

    first = vectors.where(F.pmod(F.xxhash64("id"), F.lit(FLOOR_SHARE)) == 0)
    floor = (np.zeros(len(weighted), np.int64), np.full(len(weighted), NO_ID))
    for r in search(first, None).where(F.col("rank") == k).collect():  # one row per item of the block
        floor[0][r["item"]] = r["score"]
        floor[1][r["item"]] = NO_ID if r["id"] is None else r["id"]
    names = spark.createDataFrame([(n, rows[place].item_id) for n, place in enumerate(block.places)],
                                  f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
    return search(vectors, floor).join(names, "item").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0.

    Equal scores by ascending id, rows without an id last.  Null and empty texts have
    no terms: such items have no rows, such documents count nowhere.  Each row of
    ``docs`` is a document, repeated ids too; equal rows of ``items`` are one item,
    different texts of one id are ranked apart.  Empty tables give an empty one.
    """
    spark = docs.sparkSession
    own = items.select(items[f"`{item}`"].alias("item_id"), items[f"`{item_text}`"].cast("string").alias("text"))
    own = own.where("text is not null").distinct()
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // BLOCK_CHARS)
    found = []
    for b in range(n):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        found.append(_block(spark, docs, part, k, id, text))
    found = [f for f in found if f is not None]
    if not found:
        kind = own.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
