"""Top items per user by inner product, exactly, with a bound that ends the search.

Items are packed once into blocks by falling norm, as a table in the shared folder that
lies in that order too.  Users are dealt over as many tasks as the products need: a task
reads run after run of blocks, one matrix product each, and a user is done where their
norm times the largest norm of the next run is below their n-th score, as no item
further on can do better.  No pair is shuffled or collected.

The product of a run is one of floats: it only tells, by a bound of its error, which
items may reach a user's n-th score.  Those few are scored again in doubles, one sum
from the first place to the last, so equal vectors have equal scores.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import shared_dir

#: Items of a block, about; users that are searched together; bytes of blocks a worker keeps.
BLOCK_ROWS, USER_ROWS, KEPT_BYTES = 1024, 16384, 64 << 20
#: Items of a run of blocks, at most, where a block has no more; the least share of its first norm that a block of it has.
RUN_ROWS, RUN_NORM = 4096, 0.98
#: Products of users and items that one task makes, about; pairs that are scored again together.
TASK_PRODUCTS, EXACT_ROWS = 4_000_000_000, 1 << 16
#: Users whose scores with a block are held together.
SCORED_ROWS = 512
#: Bytes of blocks that are stored, and so read, together.
GROUP_BYTES = 1 << 20
#: Ranges of norms, at most.
RANGES = 1024


def pack_items(items: DataFrame, item: str, vec: str, block_rows: int = BLOCK_ROWS) -> str:
    """Write (norm, size, ids, vecs) rows, a block each; returns the folder.

    Blocks are ranges of the norm from a sketch, cut by a hash of the id where a range
    holds many items; ``norm`` is the largest of the block.
    """
    rows = items.select(F.col(item).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = rows.where("id is not null and vec is not null")
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))
    size = items.count()
    ranges = min(RANGES, max(1, size // block_rows))
    shares = F.from_json(F.lit(str([i / ranges for i in range(1, ranges)])), "array<double>")
    splits = rows.agg(F.percentile_approx("norm", shares, 10_000).alias("q")).first()["q"] if ranges > 1 else None
    rows = rows.withColumn("range", _range_of("norm", sorted(set(splits or []))))
    # a row per range
    counts = rows.groupBy("range").agg(F.ceil(F.count("*") / block_rows).alias("parts"))
    rows = rows.join(F.broadcast(counts), "range").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    # blocks that are read one after the other lie beside each other
    rows = rows.select("range", "part", "norm", "id", "vec").repartitionByRange("range", "part")

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        return pd.DataFrame({"norm": [part["norm"].max()], "size": [len(part)], "ids": [part["id"].to_numpy("<i8").tobytes()],
                             "vecs": [np.stack(part["vec"].to_numpy()).astype("<f8").tobytes()],
                             "block": [uuid.uuid4().hex]})

    path = f"{shared_dir(items.sparkSession).rstrip('/')}/items-{uuid.uuid4().hex}"
    rows.groupBy("range", "part").applyInPandas(
        packed, "norm double, size int, ids binary, vecs binary, block string").write.options(
            **{"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 4}).parquet(path)
    return path


def _range_of(c: str, splits: list, step: int = 32):
    """How many of the ``splits`` are below a column, by every ``step``-th of them and then by those between.

    The column is one element of an array, so it is worked out once and not for each split.
    """
    held, coarse = (F.from_json(F.lit(str(x)), "array<double>") for x in (splits, splits[step - 1::step]))

    def below(x):
        first = F.size(F.filter(coarse, lambda s: s < x)) * step
        return first + F.size(F.filter(F.slice(held, first + 1, step), lambda s: s < x))

    return F.element_at(F.transform(F.array(c), below), 1)


class ItemBlocks:
    """The packed blocks by falling norm, read one at a time; a worker keeps the first ones.

    Every search starts with the first block and reads on in order, so the first blocks
    are those that are asked for again.
    """

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path) if ":" in path else (None, path)
        self.table = ds.dataset(inner, filesystem=store, format="parquet")
        # a block is read from the row group that holds it, not looked for in the whole table
        groups = [g for f in self.table.get_fragments() for g in f.split_by_row_group()]
        known = [(r["norm"], r["block"], g, r["size"]) for g in groups
                 for r in g.to_table(columns=["norm", "block", "size"], schema=self.table.schema).to_pylist()]
        known.sort(key=lambda r: r[:2], reverse=True)
        self.order, self.group, self.size = [r[:2] for r in known], [r[2] for r in known], [r[3] for r in known]
        self.kept_bytes, self.held, self.cache = kept_bytes, 0, {}

    def read(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids ascending, vectors) of the ``k``-th block."""
        return self._read([k])[0]

    def _read(self, ks) -> list[tuple[np.ndarray, np.ndarray]]:
        """The blocks ``ks``; a row group that holds several is read once."""
        found, groups = {k: self.cache[k] for k in ks if k in self.cache}, {}
        for k in (k for k in ks if k not in found):
            groups.setdefault((self.group[k].path, self.group[k].row_groups[0].id), []).append(k)
        for asked in groups.values():
            table = self.group[asked[0]].to_table(schema=self.table.schema, columns=["block", "ids", "vecs"])
            at = {b: i for i, b in enumerate(table.column("block").to_pylist())}
            for k in asked:
                own = at[self.order[k][1]]
                ids = np.frombuffer(table.column("ids")[own].as_py(), "<i8")
                found[k] = ids, np.frombuffer(table.column("vecs")[own].as_py(), "<f8").reshape(len(ids), -1)
        for k in ks:
            size = sum(x.nbytes for x in found[k])
            if k not in self.cache and self.held + size <= self.kept_bytes:
                self.cache[k] = found[k]
                self.held += size
        return [found[k] for k in ks]

    def run(self, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(the block after it, ids, vectors) of the run of blocks of about one norm that begins with the ``k``-th."""
        end, rows = k + 1, self.size[k]
        while (end < len(self.order) and rows + self.size[end] <= RUN_ROWS
               and self.order[end][0] >= RUN_NORM * self.order[k][0]):
            rows, end = rows + self.size[end], end + 1
        parts = self._read(range(k, end))
        return end, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


_OPEN: dict = {}


def _blocks(path: str) -> ItemBlocks:
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = ItemBlocks(path)
    return _OPEN[path]


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n highest of each row, ties by smaller id, in any order."""
    if scores.shape[1] <= n:
        return scores, ids
    at = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    top, own = np.take_along_axis(scores, at, axis=1), np.take_along_axis(ids, at, axis=1)
    last = top.min(axis=1)
    # more at the n-th score than there is room for: the smaller ids stay
    for r in np.flatnonzero((scores >= last[:, None]).sum(axis=1) > n):
        first = np.lexsort([ids[r], -scores[r]])[:n]
        top[r], own[r] = scores[r][first], ids[r][first]
    return top, own


def _exact(vectors: np.ndarray, matrix: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The scores of some pairs, each one sum from the first place to the last."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), EXACT_ROWS):
        part = slice(at, at + EXACT_ROWS)
        each = vectors[rows[part]] * matrix[cols[part]]
        out[part] = np.cumsum(each, axis=1, out=each)[:, -1] if each.shape[1] else 0.0
    return out


def _may_reach(vectors, norms, matrix, scaled, norm, last, n) -> np.ndarray:
    """Which items may have a score that reaches ``last``, or the n-th of this run: all that do, and few others."""
    if scaled is None or not np.isfinite(norms).all():  # no bound of the error
        found = vectors @ matrix.T
        return found >= (last - 1e-9 * np.abs(last))[:, None]
    size = np.where(norms > 0, norms, 1.0)
    found = (vectors / size[:, None]).astype(np.float32) @ scaled.T
    # of products of floats whose vectors are no longer than 1, their rounding to floats included; twice that for the rest
    error = 2 * (matrix.shape[1] + 8) * 2.0 ** -23
    floor = last / (size * norm) - error
    if found.shape[1] > n and (open_ := np.flatnonzero(np.isneginf(last))).size:
        floor[open_] = np.partition(found[open_], -n, axis=1)[:, -n].astype(float) - 2 * error
    return found >= floor.astype(np.float32)[:, None]


def search(blocks: ItemBlocks, vectors: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(scores, ids, products made): n columns per row in order, -inf where there are fewer items."""
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * (1 + 1e-9)
    none = np.iinfo(np.int64).max
    scores, ids = np.full((len(vectors), n), -np.inf), np.full((len(vectors), n), none)
    last, made, k = scores.min(axis=1), 0, 0
    while k < len(blocks.order):
        norm = blocks.order[k][0]
        open_ = np.flatnonzero(norms * norm >= last)
        if not len(open_):
            break
        k, own, matrix = blocks.run(k)
        top = norm * (1 + 1e-9) if norm > 0 else 1.0
        scaled = (matrix / top).astype(np.float32) if np.isfinite(top) else None
        for at in range(0, len(open_), SCORED_ROWS):
            some = open_[at:at + SCORED_ROWS]
            reach = _may_reach(vectors[some], norms[some], matrix, scaled, top, last[some], n)
            hit = np.flatnonzero(reach.any(axis=1))  # most rows have nothing here that reaches their n-th score
            row, col = np.divmod(np.flatnonzero(reach[hit]), len(own))
            row = hit[row]
            made += len(some) * len(own)
            found = _exact(vectors, matrix, some[row], col)
            keep = found >= last[some[row]]
            row, col, found = row[keep], col[keep], found[keep]
            if not len(row):
                continue
            # as wide as the row with the most
            better, start, many = np.unique(row, return_index=True, return_counts=True)
            line = np.repeat(np.arange(len(better)), many)
            place = np.arange(len(row)) - np.repeat(start, many)
            wide, wide_ids = np.full((len(better), many.max()), -np.inf), np.full((len(better), many.max()), none)
            wide[line, place], wide_ids[line, place] = found, own[col]
            some = some[better]
            scores[some], ids[some] = _best(
                np.concatenate([scores[some], wide], axis=1), np.concatenate([ids[some], wide_ids], axis=1), n)
            last[some] = scores[some].min(axis=1)
    order = np.lexsort([ids, -scores], axis=1)
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1), made


def top_items(users: DataFrame, items: DataFrame, n: int, user="user_id", item="clue_id",
              user_vec="user_embedding", item_vec="item_embedding",
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(user, item, score, rank), rank 1..n; ties by smaller item id.  Null vectors take no part."""
    path = pack_items(items, item, item_vec, block_rows)

    def run(batches):
        blocks = _blocks(path)
        for pdf in batches:
            for low in range(0, len(pdf), USER_ROWS):
                part = pdf.iloc[low:low + USER_ROWS]
                scores, ids, _ = search(blocks, np.stack(part["vec"].to_numpy()).astype(float), n)
                row, at = np.nonzero(scores > -np.inf)
                yield pd.DataFrame({user: part["id"].to_numpy()[row], item: ids[row, at],
                                    "score": scores[row, at], "rank": (at + 1).astype("int32")})

    rows = users.select(F.col(user).cast("long").alias("id"), F.col(user_vec).cast("array<double>").alias("vec"))
    rows = rows.where("vec is not null")
    # a file of vectors is small beside its products, and would be few tasks
    tasks = -(-rows.count() * items.count() // TASK_PRODUCTS)
    if tasks > 1:
        rows = rows.repartition(tasks)
    return rows.mapInPandas(
        run, f"{user} bigint, {item} bigint, score double, rank int")


def recall_at_n(users: DataFrame, items: DataFrame, truth: DataFrame, n: int, user="user_id",
                item="clue_id", **kw) -> DataFrame:
    """One row: positives of users and items that have vectors, those in the top n, the share."""
    wanted = truth.select(user, item).distinct()
    wanted = wanted.join(users.select(user), user, "left_semi")
    wanted = wanted.join(items.select(item), item, "left_semi")
    # only users with a positive are scored
    asked = users.join(wanted.select(user).distinct(), user, "left_semi")
    top = top_items(asked, items, n, user, item, **kw).select(user, item, F.lit(1).alias("_hit"))
    both = wanted.join(top, [user, item], "left")
    out = both.agg(F.count("*").alias("positives"), F.count("_hit").alias("found"))
    return out.withColumn(
        "recall", F.expr("round(try_divide(found, positives), 6)"))
