"""The filter audit, byte-level BPE and ranked search against plain versions, and their edge cases."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.json"
WORD = re.compile("[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 9000}" for i in range(30000))
ROWS = [(1, "The old mill by the river", "a"), (2, "The old mill by the river", "a"), (2, "The old mill by the river", None),
        (None, "The old mill by the river", "b"), (3, None, "b"), (4, "", "b"), (5, " \n ", ""), (6, LONG, "a"),
        (7, "RIVER river 100% É é \U0001F600\0", "b"), (8, "x" * 70000 + " end", "a"), (9, "mill mill mill", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(1) for c in ("_row", "digest", "ids", "n", "rank", "score", "part", "fails", "_text")})


def prose(seed, n, words="river mill old stone bridge the The OF of a near # 5% wind".split()):
    r = random.Random(seed)
    return [(i, " ".join(r.choices(words, k=r.choice([0, 3, 20, 60, 90]))) if r.random() > .1 else r.choice([None, "", "same text"]),
             r.choice(["s", "t", None])) for i in range(n)]


# -- filters ---------------------------------------------------------------------------


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    judged = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and i > first[t]}
        judged.append((s or "", {f for f in "ABCDE" if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                hit = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                total[f] += len(hit)
                out[part, "".join(order), k + 1] = [
                    len(left), len(hit), sum(f in j[1] for j in own) - len(hit), sum(j[1] == {f} for j in own),
                    sum(j[2] for j in hit), sum(j[3] for j in hit)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(total[order[k - 1]])
    return out


def audited(spark, rows, labels, docs=None):
    from paddock.llm.filter_audit import audit, judged

    docs = spark.createDataFrame(rows, "doc_id long, text string, source string") if docs is None else docs
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("fails", F.lit(3))
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in audit(judged(docs, marks)).collect()}


def test_filter_audit(spark, docs):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 2)] + [(4, 1, None), (4, 0, 1), (None, 1, 1), (3, None, None)]
    rows = prose(3, 150) + prose(4, 40)
    assert audited(spark, rows, labels) == brute_audit(rows, labels)
    assert audited(spark, ROWS, labels, docs) == brute_audit(ROWS, labels)
    assert audited(spark, [], labels) == {} and audited(spark, [], [], docs.limit(0)) == {}
    assert audited(spark, rows, []) == brute_audit(rows, [])


def test_transducer_counts():
    from paddock.llm import byte_transducer as B

    r = random.Random(1)
    texts = ["", "a b a", " x ", "É \xa0 z A#|", "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y", "", "q" * 3000,
             *["".join(r.choices("ab AB#é\n\t世", k=r.randint(0, 60))) for _ in range(400)], LONG]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    want = [[len(w := WORD.findall(t)), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t))]
            for t in texts]
    block = B.BLOCK
    try:
        for B.BLOCK in (block, 7):  # texts and words across many blocks
            assert B.measured(np.concatenate(data), offsets).tolist() == want
    finally:
        B.BLOCK = block


def test_words_with_one_hash_are_told_apart():
    from paddock.llm.byte_transducer import Spans, first_of_each, transduce

    data = np.frombuffer(b"one two one three two ones", np.uint8)
    starts, ends, _ = transduce(data, np.array([0, len(data)]))
    spans = Spans(data, starts, ends, np.zeros(len(starts), np.int64))
    assert first_of_each(spans, np.zeros(len(starts), np.uint64)).sum() == 4


# -- byte pairs ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_PAIRS)


@pytest.fixture(scope="module")
def merges():
    from paddock.llm.pair_merges import Merges

    return Merges.load(BYTE_PAIRS)


ALPHABET = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\t", "é", "世", "１", "Ⅳ", "!", "#", "՘", "꟎", "\x1c", "\x85", "\xa0",
            " ", "\U0001F600", "<|endoftext|>", "<|end", "1", "\0", "I'm", "aaaa", "࢏"]


def test_ids_are_those_of_the_library(merges, library):
    from paddock.llm import byte_bpe as B

    r = random.Random(5)
    texts = ["".join(r.choices(ALPHABET, k=r.randint(0, 40))) for _ in range(3000)] + [
        "x" * 5000 + " " + "ab " * 9000, "b" + "a" * 3001 + "c", "".join(r.choices("abcdetsr", k=4000)), LONG]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    sizes = B.TOGETHER, B.KEPT
    try:
        for B.TOGETHER, B.KEPT in (sizes, (50, 20)):  # many slices of a text, a cache that is always full
            encoder = B.Encoder(merges, B._newer())
            some = range(len(texts)) if B.KEPT > 20 else range(2900, len(texts))
            got = encoder.encode([texts[i] for i in some])
            assert [np.frombuffer(g, "<u4").tolist() for g in got] == [want[i] for i in some]
            assert len(encoder.known) < B.KEPT + B.TOGETHER + 10000
    finally:
        B.TOGETHER, B.KEPT = sizes


def test_long_words_by_windows(merges, library):
    from paddock.llm.pair_merges import merge_long, merge_words

    r = random.Random(6)
    for word in ["ab", "a" * 777, "b" + "a" * 500 + "b" * 77, *["".join(r.choices(s, k=1500)) for s in ("aab", "therinds", "abcXYZ0-")]]:
        ids = merge_words(merges, [word.encode()])[0]
        assert merge_long(merges, word.encode()) == ids
    assert np.frombuffer(merge_long(merges, b"therein" * 900), "<u4").tolist() == library.encode("therein" * 900, add_special_tokens=False).ids


def test_encode_and_decode_columns(spark, docs, merges, library):
    from paddock.llm.byte_bpe import Shared, decode, encode

    shared = Shared(spark, merges)
    for table in (docs, docs.limit(0), docs.select("text")):
        encoded = encode(table, shared)
        rows = decode(encoded.select("_row", "ids", "n_tokens", "ids_sha256"), shared).select("_row.*", "decoded").collect()
        assert len(rows) == table.count()
        assert table.columns == ["text"] or "_row" in encoded.select("_row.*").columns
    encoded = encode(docs.select("doc_id", "text", "source"), shared).select("_row.doc_id", "ids", "n_tokens", "ids_sha256")
    got = sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded) for x in decode(encoded, shared).select("_row.*", "decoded").collect())
    want = []
    for i, t, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), t or ""))
    assert got == sorted(want)
    odd = spark.createDataFrame([(1, [15, None, -1, 999999, 50256]), (2, None), (3, [162])], "id long, ids array<int>")
    back = {x.id: x.decoded for x in decode(odd, shared).select("_row.id", "decoded").collect()}
    assert back == {1: library.decode([15, 50256], skip_special_tokens=False), 2: None,
                    3: library.decode([162], skip_special_tokens=False)}


def test_other_vocabularies_are_refused(tmp_path, merges):
    from paddock.llm.pair_merges import Merges

    with pytest.raises(ValueError):
        Merges.load("/opt/tokenizers/word_bpe_49k.json")
    with pytest.raises(ValueError):  # one text made by two merges
        Merges.of({"a": 0, "b": 1, "ab": 2, "bb": 3, "abb": 4, **{c: 10 + i for i, c in enumerate(
            c for c in map(chr, range(0x21, 0x180)) if c not in "ab")}},
            [("a", "b"), ("b", "b"), ("ab", "b"), ("a", "bb")], {})


# -- ranked search ---------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_ranking(docs, items, k=10):
    lists = [(i, terms(t)) for i, t in docs]
    lists = [(i, t) for i, t in lists if t]
    n_docs, total, df = len(lists), sum(len(t) for _, t in lists), {}
    for _, t in lists:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = set()
    for item, text in set(items):
        scored = []
        for i, t in lists:
            m = 25 + 75 * len(t) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (
                10**9 * t.count(w) // (1000 * t.count(w) + 8 * m)) for w in terms(text) if w in df)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k])}
    return out


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(7)
    words = [f"w{i}" for i in range(300)] + ["É", "MILL", "mill"]
    skewed = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(r.choices(words, skewed, k=r.randint(1, 60)))) for i in range(1500)]
    docs += [(5000 + i, docs[17][1]) for i in range(400)] + [(None, docs[3][1]), (3, docs[3][1]), (9000, None), (9001, "! ?")]
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(90)]
    items += [(90, docs[17][1]), (91, None), (92, ""), (93, "unheard of"), (1, items[1][1]), (1, "mill w3"), (None, "w5 w5 mill")]
    return docs, items


@pytest.mark.parametrize("block", [None, 700])
def test_ranked_search(spark, corpus, block, monkeypatch):
    from paddock.llm import lexical_search as L

    if block:
        monkeypatch.setattr(L, "BLOCK_CHARS", block)
    docs, items = corpus
    got = L.best_documents(spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3),
                           spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1)))
    rows = [tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_ranking(docs, items)


def test_ranked_search_of_empty_tables(spark, corpus):
    from paddock.llm.lexical_search import best_documents

    docs = spark.createDataFrame(corpus[0][:5], "doc_id long, text string")
    items = spark.createDataFrame(corpus[1][:5], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, items.withColumn("text", F.lit(None).cast("string")))):
        assert best_documents(d, i).count() == 0


def test_bounds_leave_out_pairs_but_no_result():
    from paddock.llm.impact_trees import Best, ItemTrees, search_chunk

    r = np.random.RandomState(8)
    vectors = []
    for _ in range(150):
        ids = np.unique(r.randint(0, 60, 6) + 60 * r.randint(0, 8))
        vectors.append((ids, r.randint(1, 9000, len(ids)).astype(np.int64)))
    n = 1000
    row, term = np.nonzero((r.rand(n, 480) < .08) & (np.arange(480) // 60 == r.randint(0, 8, n)[:, None]))
    impact = r.randint(1, 10**6, len(row)).astype(np.int64)
    dense = np.zeros((n, 480), np.int64)
    dense[row, term] = impact
    for highest in (10**6, 10**15):  # in floats, and in 64-bit integers
        best = Best(len(vectors), 10)
        trees = ItemTrees(vectors, highest)
        scored = sum(search_chunk(trees, best, row[own] % 100, term[own], impact[own], np.arange(p, p + 100))
                     for p in range(0, n, 100) for own in [row // 100 == p // 100])
        for i, (ids, weights) in enumerate(vectors):
            scores = dense[:, ids] @ weights
            order = np.lexsort([np.arange(n), -scores])[:10]
            order = order[scores[order] > 0]
            assert best.scores[i][:len(order)].tolist() == scores[order].tolist()
            assert best.ids[i][:len(order)].tolist() == order.tolist()
        assert scored < 0.5 * n * len(vectors)


def test_terms_are_cut_at_their_ends(monkeypatch):
    from paddock.llm import lexical_search as L

    text = ("ab cd," + "e" * 50 + " F g-h ").encode() * 3
    whole = [w for part in L.terms_of(text) for w in part]
    monkeypatch.setattr(L, "SLICE", 7)
    assert [w for part in L.terms_of(text) for w in part] == whole and whole[:3] == [b"ab", b"cd", b"e" * 50]
    big = np.array([10**9], np.int64)
    assert L.floor_div(big, 10**12, 7 * 10**10)[0] == 75 * 10**21 // (7 * 10**10)
