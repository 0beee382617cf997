"""Segmentations against all segmentations of small texts, and exact round trips."""

import random
import struct

import pytest

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def lattice():
    from paddock.llm.piece_lattice import Lattice, Pieces

    return Lattice(Pieces.load(PATH))


def every(lattice, text):
    whole = "▁" + text.replace(" ", "▁") if text else ""
    out = []

    def go(i, score, ids):
        if i == len(whole):
            out.append((score, tuple(ids)))
        for j in range(i + 1, min(len(whole), i + 16) + 1):
            found = lattice.known.get(whole[i:j])
            if found:
                go(j, score + found[0], [*ids, found[1]])
            elif j == i + 1:
                extra, cost = lattice._fallback(whole[i])
                go(j, score + cost, [*ids, *extra])

    go(0, 0, [])
    return sorted(out, key=lambda x: -x[0])


def unpacked(ids):
    return struct.unpack(f"<{len(ids) // 4}i", ids)


def test_n_best_of_small_texts(lattice):
    draw = random.Random(1)
    texts = ["", "a", "the  cat", "öx\nab", "hi 日本 ö", " lead", "trail ", "a b c"] + [
        "".join(draw.choice("thein o\n") for _ in range(9)) for _ in range(40)]
    for text in texts:
        want = every(lattice, text)
        for n in (1, 2, 4, 7):
            got = [(s, unpacked(ids)) for s, ids in lattice.nbest(text, n)]
            assert [s for s, _ in got] == [s for s, _ in want[:n]]
            assert len(set(got)) == len(got) and set(got) <= set(want)


def test_batched_search_equals_single_search(lattice):
    draw = random.Random(2)
    words = ["".join(draw.choice("aeinrst") for _ in range(draw.randint(1, 13))) for _ in range(500)]
    lattice.prepare([" ".join(words), "aaaa aaaaaaa aaaaaaaaaaa"])
    for part in lattice.parts(" " + " ".join(words) + " aaaa aaaaaaa"):
        assert lattice.cache[part] == lattice.segment(part)


def test_round_trips(spark, lattice):
    from paddock.llm.piece_lattice import Pieces
    from paddock.llm.sentencepieces import decode, encode

    texts = ["", None, "a  b\t\n", "▁ literal", "\0x", "日本 ö \U0001F600", "w" * 5000, "x " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = encode(df, Pieces.load(PATH)).select("_row.doc_id", "_row.text", "ids", "scores", "round_trip")
    rows = coded.collect()
    assert all(r.round_trip for r in rows) and len(rows) == len(texts)
    back = {r.doc_id: r.decoded for r in decode(coded, Pieces.load(PATH)).select("_row.doc_id", "decoded").collect()}
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]
    bad = spark.createDataFrame([([10 ** 6],), (None,)], "ids array<int>")
    assert [r.decoded for r in decode(bad, Pieces.load(PATH)).collect()] == [None, None]
    assert encode(df.limit(0), Pieces.load(PATH)).count() == 0


def test_every_segmentation_is_given(spark, lattice):
    """The second best and on as ids, which decode to the text and have the digests."""
    import zlib

    from paddock.llm.piece_lattice import Pieces
    from paddock.llm.sentencepieces import decode, encode, segmentation
    from pyspark.sql import functions as F

    texts = ["the  cat\nsat", "", None, "a", "öx thein", "w" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = encode(df, Pieces.load(PATH))
    coded = coded.withColumn("others", F.transform("others", lambda e: segmentation(F.col("ids"), e)))
    for r in coded.select("_row.text", "ids", "others", "scores", "digests").collect():
        every = [r.ids, *r.others]
        assert len(every) == len(r.scores) == len({tuple(x) for x in every})
        assert [f"{zlib.crc32(struct.pack(f'<{len(x)}i', *x)):08x}" for x in every] == r.digests
        assert every == [list(unpacked(x)) for _, x in lattice.nbest(r.text or "", 4)]
    rows = coded.selectExpr("_row.text", "explode(others) as ids")
    assert all(r._row.text == r.decoded for r in decode(rows, Pieces.load(PATH)).collect())


def test_a_small_cache_of_segments_changes_no_result(lattice):
    from paddock.llm.piece_batches import Segments

    draw = random.Random(3)
    texts = [" ".join("".join(draw.choice("aeinrst") for _ in range(draw.randint(1, 18))) for _ in range(30))
             for _ in range(40)]
    want, whole = [lattice.nbest(t, 4) for t in texts], lattice.cache
    lattice.cache = Segments(50)
    try:
        for t, w in zip(texts, want):
            assert lattice.nbest(t, 4) == w and len(lattice.cache.names) <= 50 + 31
    finally:
        lattice.cache = whole


def test_two_best_of_long_segments():
    """Segments searched together are as those searched alone: scores, losses and ids, with ties, at any length."""
    import random

    from paddock.llm.piece_batches import Batches, Segments
    from paddock.llm.piece_lattice import UNIT, Lattice, Pieces

    draw = random.Random(5)
    texts = ["▁", "a", "b", *sorted({"".join(draw.choice("ab") for _ in range(draw.randint(2, 3))) for _ in range(5)})]
    lattice = Lattice(Pieces(tuple(texts), tuple(-UNIT * draw.randint(1, 3) for _ in texts), (), 0))
    batches = Batches(lattice.known, lattice.pieces.scores)
    parts = [" " * draw.randint(0, 1) + "".join(draw.choice("ab") for _ in range(draw.randint(1, 40))) for _ in range(500)]
    scores, losses, ids, sizes = batches.two_best([p.replace(" ", "▁") for p in parts])
    at = 0
    for part, score, loss, size in zip(parts, scores, losses, sizes):
        alone = lattice.segment(part)
        assert (score, None if loss == Segments.ALONE else loss) == alone[:2]
        assert ids[at:at + size].astype("<i4").tobytes() == alone[2]
        at += size
    assert at == len(ids) and max(sizes) > 15
