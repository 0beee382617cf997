"""Batch forward pass of one feed-forward tower.

The weights are a packed table in the shared folder, from which the tasks read what
they need: embedding rows by block, and the dense layers, whose size follows from the
shape of the network.  Rows go through in Arrow batches, one matrix product per layer.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from paddock.sources.models import PackedModel, opened, pack_weights

# Layer widths.
DENSE_WIDTH = 64
HIDDEN = (256, 128)
VECTOR = 32


@dataclass
class TowerSpec:
    """Columns in model order; every sparse column names its embedding layer."""

    sparse: dict = field(default_factory=dict)
    dense: list = field(default_factory=list)
    sparse_seq: dict = field(default_factory=dict)
    dense_seq: list = field(default_factory=list)

    def columns(self) -> list[str]:
        return [*self.sparse, *self.dense, *self.sparse_seq, *self.dense_seq]


def _dense(x, w: PackedModel, name, relu=True):
    y = x @ w.matrix(name)
    if f"{name}_bias" in w:
        y = y + w.matrix(f"{name}_bias")[0]
    return np.maximum(y, 0.0) if relu else y


def forward(pdf: pd.DataFrame, spec: TowerSpec, w: PackedModel) -> np.ndarray:
    """(rows, 32) vectors of one batch; biases are layers named ``<layer>_bias``."""
    parts = []
    for c, layer in spec.sparse.items():
        parts.append(w.rows(layer, pdf[c].to_numpy(int)))
    if spec.dense:
        parts.append(_dense(pdf[spec.dense].to_numpy(float), w, "dense"))
    for c, layer in spec.sparse_seq.items():
        parts.append(w.rows(layer, np.stack(pdf[c].to_numpy()).astype(int)).mean(axis=1))
    if spec.dense_seq:
        flat = np.concatenate([np.stack(pdf[c].to_numpy()) for c in spec.dense_seq], axis=1)
        parts.append(_dense(flat.astype(float), w, "dense_seq"))
    x = np.concatenate(parts, axis=1)
    for i in range(len(HIDDEN)):
        x = _dense(x, w, f"hidden_{i}")
    return _dense(x, w, "vector", relu=False)


def tower_forward(features: DataFrame, weights: DataFrame | str, spec: TowerSpec, key: str,
                  out: str = "embedding") -> DataFrame:
    """(key, vector) for every row of ``features``; model inputs must not be null.

    ``weights`` is the folder of a packed model, or its cells, which are packed first.
    """
    path = weights if isinstance(weights, str) else pack_weights(weights)

    def run(batches):
        w = opened(path)
        for pdf in batches:
            if len(pdf):
                vectors = forward(pdf, spec, w).astype("float32")
                yield pd.DataFrame({key: pdf[key], out: list(vectors)})

    # the key may be a model input as well: select each column once
    cols = list(dict.fromkeys([key, *spec.columns()]))
    kind = features.schema[key].dataType.simpleString()
    return features.select(*cols).mapInPandas(run, f"{key} {kind}, {out} array<float>")
