"""Models as packed tables in the shared folder.

Weights come as rows (layer, row, col, value).  Spark packs them into rows of one
binary block each, block by block; tasks read the blocks they need, once per worker.
The driver sees neither weights nor blocks, and no model is too large: a worker keeps
a bounded number of bytes of them.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import shared_dir

__all__ = ["pack_weights", "PackedModel", "opened"]

#: Rows of a matrix in one block, and bytes of blocks a worker keeps.
BLOCK_ROWS, KEPT_BYTES = 4096, 256 << 20


def pack_weights(weights: DataFrame, path: str | None = None, block_rows: int = BLOCK_ROWS) -> str:
    """Write the packed table, by layer; returns its folder.  Cells that are not there are 0."""
    path = path or f"{shared_dir(weights.sparkSession).rstrip('/')}/model-{uuid.uuid4().hex}"
    shapes = weights.groupBy("layer").agg(
        (F.max("row") + 1).cast("long").alias("rows"), (F.max("col") + 1).cast("long").alias("cols"))
    cells = weights.select("layer", "row", "col", F.col("value").cast("double").alias("value"),
                           F.floor(F.col("row") / block_rows).cast("long").alias("block"))
    # one row per layer
    cells = cells.join(F.broadcast(shapes), "layer")

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        layer, block, rows, cols = part[["layer", "block", "rows", "cols"]].iloc[0]
        first = block * block_rows
        matrix = np.zeros((min(block_rows, rows - first), cols), "<f8")
        matrix[part["row"].to_numpy() - first, part["col"].to_numpy()] = part["value"].to_numpy()
        return pd.DataFrame({"block": [block], "size": [block_rows], "rows": [rows], "cols": [cols], "data": [matrix.tobytes()], "layer": [layer]})

    out = cells.groupBy("layer", "block").applyInPandas(
        packed, "block long, size long, rows long, cols long, data binary, layer string")
    out.write.mode("overwrite").partitionBy("layer").parquet(path)
    return path


class PackedModel:
    """Reads matrices of a packed table by rows."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (None, path)
        kind = ds.partitioning(pa.schema([("layer", pa.string())]), flavor="hive")
        self.table = ds.dataset(inner, filesystem=store, format="parquet", partitioning=kind)
        known = self.table.to_table(columns=["layer", "block", "size", "rows", "cols"]).to_pylist()
        self.shapes = {r["layer"]: (r["rows"], r["cols"]) for r in known}
        self.size = known[0]["size"] if known else BLOCK_ROWS
        self.blocks = {(r["layer"], r["block"]) for r in known}
        self.kept_bytes, self.held = kept_bytes, 0
        self.cache: OrderedDict = OrderedDict()

    def __contains__(self, layer: str) -> bool:
        return layer in self.shapes

    def _block(self, layer: str, block: int) -> np.ndarray:
        key = (layer, block)
        if key in self.cache:
            self.cache.move_to_end(key)
            return self.cache[key]
        import pyarrow.compute as pc

        rows, cols = self.shapes[layer]
        if key in self.blocks:
            found = self.table.to_table(columns=["data"], filter=(pc.field("layer") == layer) & (pc.field("block") == block))
            matrix = np.frombuffer(found.column("data")[0].as_py(), "<f8").reshape(-1, cols)
        else:  # a block without any cell
            matrix = np.zeros((min(self.size, rows - block * self.size), cols))
        self.cache[key] = matrix
        self.held += matrix.nbytes
        while self.held > self.kept_bytes and len(self.cache) > 1:
            self.held -= self.cache.popitem(last=False)[1].nbytes
        return matrix

    def rows(self, layer: str, ids: np.ndarray) -> np.ndarray:
        """The rows of a matrix by id; ids outside of it are unknown: 1."""
        n, cols = self.shapes[layer]
        ids = np.where((ids >= 0) & (ids < n), ids, min(1, n - 1))
        out = np.empty((*ids.shape, cols))
        block = ids // self.size
        for b in np.unique(block).tolist():
            here = block == b
            out[here] = self._block(layer, b)[ids[here] - b * self.size]
        return out

    def matrix(self, layer: str) -> np.ndarray:
        """A whole (dense) layer, whose size is given by the shape of the network."""
        return self.rows(layer, np.arange(self.shapes[layer][0]))


_OPEN: dict = {}


def opened(path: str) -> PackedModel:
    """One open model per worker and folder."""
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = PackedModel(path)
    return _OPEN[path]
