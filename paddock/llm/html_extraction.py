"""The main text of pages: a scan into blocks, and a recurrent network that labels every block.

The network is trained in one task on at most ``SAMPLE`` pages of at most
``LONGEST`` characters, chosen by a hash of their id, and on layouts drawn with
a fixed seed; that is the only bounded step.  Every page is then read whole where
it lies: no shuffle, a batch of pages in memory.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.block_labeller import Labeller, features, fit, label
from paddock.llm.block_layouts import training_pages
from paddock.llm.common import packed
from paddock.llm.html_blocks import blocks_of

SAMPLE, LONGEST = 400, 60_000
#: Pages that are labelled together.
TOGETHER = 256


def labeller(df: DataFrame, key: str = "page_id", page: str = "html", size: int = SAMPLE) -> Labeller:
    """A network for the pages of ``df``; without any page it learns from drawn layouts alone."""
    texts = df.select(df[f"`{key}`"].alias("k"), df[f"`{page}`"].alias("page")).where(
        "page is not null and length(page) <= " + str(LONGEST))
    sample = texts.orderBy(F.xxhash64("k"), "k", "page").limit(size)

    def run(batches):
        import pyarrow as pa

        pages = sorted(p for b in batches for p in b.column(0).to_pylist())
        known = training_pages(pages)
        model = fit([features(b) for b, _ in known], [y.astype(np.float32) for _, y in known])
        yield pa.RecordBatch.from_arrays(
            [pa.array([[p.ravel().tolist() for p in model.parts()]], pa.list_(pa.list_(pa.float64())))], ["parts"])

    row = sample.select("page").coalesce(1).mapInArrow(run, "parts array<array<double>>").first()
    fresh = Labeller.fresh()
    if row is None:
        known = training_pages([])
        return fit([features(b) for b, _ in known], [y.astype(np.float32) for _, y in known])
    return Labeller(*[np.array(p, np.float32).reshape(q.shape) for p, q in zip(row.parts, fresh.parts())])


def main_text(df: DataFrame, model: Labeller, page: str = "html") -> DataFrame:
    """Every row of ``df`` as ``_row``, with ``text``, ``n_chars``, ``n_blocks`` (of
    the page) and ``n_main``.

    Blocks that the network takes for main text are joined in page order by an
    empty line; character references are decoded and white space inside a block
    is one space.  A null or empty page, and one without main text, gives an
    empty text; equal pages give equal texts; an empty table an empty one.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts, all_, main = [], [], []
            for a in range(0, b.num_rows, TOGETHER):
                pages = [blocks_of(p or "") for p in b.column(1).slice(a, TOGETHER).to_pylist()]
                chosen = label(shared.value, [features(p) if p else np.zeros((0, 1)) for p in pages])
                for blocks, keep in zip(pages, chosen):
                    texts.append("\n\n".join(x.text for x, y in zip(blocks, keep) if y))
                    all_.append(len(blocks))
                    main.append(int(keep.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()),
                 pa.array(all_, pa.int64()), pa.array(main, pa.int64())],
                ["_row", "text", "n_chars", "n_blocks", "n_main"])

    rows = packed(df, page=page)
    schema = T.StructType([rows.schema["_row"]] + T._parse_datatype_string(
        "text string, n_chars long, n_blocks long, n_main long").fields)
    return rows.mapInArrow(run, schema)
