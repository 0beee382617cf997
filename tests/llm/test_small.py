"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i}" for i in range(30000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions near the old stone bridge at dawn"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None),
            (4, "", "en", "b"), (5, " \n\t ", "en", "b"), (None, PROSE + " again", "en", "a"), (6, LONG, "fr", "b"),
            (7, "x", "de", "c"), (8, "\0 ▁ é\U0001F600", "de", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({"n_chars": F.length("text").cast("long"), "_row": F.lit(1), "score": F.lit(2),
                           "id": F.lit(3), "h": F.lit(4), "g": F.lit(5), "n": F.lit(6)})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, 0), (None, 1, 0), (6, None, None)],
                                 "doc_id long, quality int, toxic int")


def test_quality_rules(spark, docs, labels):
    from paddock.llm.quality_rules import quality_rules, ratios_from_labels

    for table in (docs, docs.limit(0)):
        rows = quality_rules(table, ratios_from_labels(table, labels)).select(
            F.col("_row.doc_id"), F.col("_row.score").alias("own"), "_quality.*").collect()
        assert len(rows) == table.count()
    rows = quality_rules(docs, ratios_from_labels(docs, labels.limit(0))).select("_row.doc_id", "_quality.*").collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == 22 and by[1].kept and not by[1].base_failed
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].score is None and not by[3].kept
    assert by[6].n_words == 30000 and by[6].n_repeat_words == 0
    assert len(rows) == docs.count() and sum(r.doc_id == 2 for r in rows) == 2


def test_repeated_words_and_lines(spark):
    from paddock.llm.quality_rules import quality_rules, ratios_from_labels

    def brute(text):
        w = text.split()
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i:i + 8]), []).append(i)
        return len({k for places in at.values() if len(places) > 1 for i in places for k in range(i, i + 8)})

    texts = ["a " * 40, "a b c d e f g h " * 3, " ".join("abcdefghijklmnopq") + " x " + " ".join("abcdefghijk"),
             "a b c d e f g h a b c d e f g h", "a b c d e f g", "l1 x\nl1 x\n\n \nl2", "a#b *c ##"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules(df, ratios_from_labels(df, none)).select("_row.doc_id", "_quality.*").collect()}
    assert [got[i].n_repeat_words for i in range(len(texts))] == [brute(t) for t in texts]
    assert got[5].n_dup_lines == 1 and got[6].n_symbols == 4 and got[6].word_chars == 7


def test_line_dedup(spark, docs):
    from paddock.llm.line_dedup import line_dedup

    rows = line_dedup(docs).select("_row.doc_id", "_lines.*").collect()
    assert len(rows) == docs.count()
    assert line_dedup(docs.limit(0)).count() == 0
    a, b = "\n".join(f"line {i} of the run" for i in range(6)), "one\ntwo"
    df = spark.createDataFrame([(1, a), (2, b + "\n" + a + "\n\nend"), (3, a), (3, a)], "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_deleted, r.emptied) for r in line_dedup(df).select("_row.doc_id", "_lines.*").collect()]
    assert sorted(got) == [(1, a, 0, False), (2, "one\ntwo\n\nend", 6, False), (3, "", 6, True), (3, "", 6, True)]


def test_line_dedup_where_the_first_copy_goes_on_differently(spark):
    from paddock.llm.line_dedup import line_dedup

    notice = " ".join(f"n{i}" for i in range(60))
    rows = [(0, f"{notice}\nu0")] + [(d, f"{notice}\nf1\nf2\nf3\nu{d}") for d in range(1, 5)]
    rows += [(5, f"{notice}\nf1\nf2\nv5"), (6, f"{notice}\nu6\nf2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup(df).select("_row.doc_id", "_lines.*").collect()}
    assert got == {0: rows[0][1], 1: "f1\nf2\nf3\nu1", 2: "u2", 3: "u3", 4: "u4", 5: "v5", 6: "u6\nf2"}


def test_near_duplicates(spark, docs):
    from paddock.llm.ngram_join import near_duplicates

    rows = [tuple(r) for r in near_duplicates(docs).collect()]
    assert len(rows) == docs.count() and near_duplicates(docs.limit(0)).count() == 0
    by = {r[0]: r for r in rows}
    assert by[1] == (1, 18, 1) and by[2] == (2, 18, 1) and by[3] == (3, 0, 3) and by[4] == (4, 0, 4)
    assert by[7] == (7, 1, 7) and by[None] == (None, 19, None)


def test_mixing(spark, docs):
    from paddock.llm.mixing import mix

    rows = mix(docs).select("_row.doc_id", "_mix.*").collect()
    assert len(rows) == docs.count() and mix(docs.limit(0)).count() == 0
    assert all(0 <= r.probability <= 1 for r in rows)
    assert len({r.taken for r in rows if r.doc_id == 2}) == 1


def test_raking_meets_the_targets(spark):
    from paddock.llm.mixing import probabilities, rake, tempered

    cells = spark.createDataFrame(
        [(f"s{i % 7}", f"l{i % 3}", str(i % 5), 10 + 37 * i % 101) for i in range(105)],
        "source string, lang string, topic string, tokens long").groupBy("source", "lang", "topic").agg(
        F.sum("tokens").alias("tokens"))
    goals = {m: tempered(cells, m) for m in ("source", "lang", "topic")}
    raked = rake(cells, goals)
    whole = cells.agg(F.sum("tokens")).first()[0]
    for m, goal in goals.items():
        both = raked.groupBy(m).agg(F.sum("w").alias("w")).join(goal, F.col(m) == F.col("value"))
        assert all(abs(r.w / whole - r.goal) < 1e-5 for r in both.collect())
    out = probabilities(raked, 0.6).agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0]
    assert abs(out / whole - 0.6) < 1e-9


def test_lm_scores(spark, docs):
    from paddock.llm.lm_scoring import score_texts

    rows = score_texts(docs, F.col("doc_id") == 1).collect()
    assert len(rows) == docs.count() and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert score_texts(docs.limit(0), F.lit(False)).count() == 0
    assert all(r.n_known == 0 for r in score_texts(docs, F.lit(True)).collect())


def test_class_probabilities_sum_to_one():
    import numpy as np

    from paddock.llm.log_bilinear import CONTEXT, Model

    model = Model.fresh(np.full(11, 1 / 11))
    contexts = np.random.RandomState(0).randint(0, 12, (5, CONTEXT))
    logs = [model.log_probabilities(contexts, np.full(5, k)) for k in range(11)]
    assert np.allclose(np.exp(logs).sum(axis=0), 1)


def test_model_levels_and_gradients():
    """A class costs its group and not all classes; gradients are those of both levels' NCE objective."""
    import numpy as np

    from paddock.llm import log_bilinear as B

    draw = np.random.RandomState(3)
    for size in (1, 2, 11, 12, 40):
        model = B.Model.fresh(draw.dirichlet(np.ones(size)))
        assert len(model.groups) <= B.group_size(size) and B.group_size(size) <= size ** .5 + 1
        model = model.like(model.flat() + draw.normal(0, .3, model.flat().size).astype(np.float32))
        contexts = draw.randint(0, size + 1, (6, B.CONTEXT))
        logs = [model.log_probabilities(contexts, np.full(6, k)) for k in range(size)]
        assert np.allclose(np.exp(logs).sum(axis=0), 1, atol=1e-5)

    frequencies = draw.dirichlet(np.ones(12))
    trainer = B.Trainer(B.Model.fresh(frequencies), frequencies, 1)
    start = trainer.model.flat() + draw.normal(0, .2, trainer.model.flat().size)
    contexts, targets, noise = draw.randint(0, 13, (30, B.CONTEXT)), draw.randint(0, 12, 30), trainer.noise()

    def goal(flat):
        parts, at = [], 0
        for p in trainer.model.parts():
            parts.append(flat[at:at + p.size].reshape(p.shape))
            at += p.size
        inputs, weights, *heads = parts
        meaning = np.column_stack([(inputs[contexts] * weights).sum(axis=1), np.ones(30)])
        total = 0
        for out, true, false, (_, base) in zip(heads, (targets, targets // trainer.size), noise, trainer.levels):
            yes, no = (meaning * out[true]).sum(axis=1) - base[true], meaning @ out[false].T - base[false]
            total += (-np.log1p(np.exp(-yes))).mean() - np.log1p(np.exp(no)).sum() / 30
        return total

    trainer.model = trainer.model.like(start)
    got = [np.zeros_like(p) for p in trainer.model.parts()]
    for full, (rows, g) in zip(got, trainer.gradients(contexts, targets, noise)):
        full[rows] = g
    got = np.concatenate([g.ravel() for g in got])
    for k in draw.choice(len(start), 120, replace=False):
        near = [start.copy(), start.copy()]
        near[0][k] += 1e-4
        near[1][k] -= 1e-4
        assert abs((goal(near[0]) - goal(near[1])) / 2e-4 - got[k]) < 2e-4


def test_model_meets_a_place_of_a_run_once():
    """Runs hold every position of the texts, few more places than targets, and give the gradients of its contexts."""
    import numpy as np

    from paddock.llm import log_bilinear as B

    draw = np.random.RandomState(5)
    texts = [draw.randint(0, 40, n) for n in (1, 3, 700, 1, 64, 2000)]
    runs = B.runs_of(texts, 40)
    padded = [np.concatenate([np.full(B.CONTEXT, 40), t]) for t in texts]
    contexts = np.array([t[k - B.CONTEXT:k][::-1] for t in padded for k in range(B.CONTEXT, len(t))])
    targets = np.concatenate(texts)
    found = runs[:, B.CONTEXT:]
    assert np.array_equal(found[found != 40], targets) and runs.size < 1.3 * len(targets)
    assert B.runs_of([], 40)[:, B.CONTEXT:].min(initial=40) == 40

    frequencies = np.sort(draw.dirichlet(np.ones(40)))[::-1]
    trainer = B.Trainer(B.Model.fresh(frequencies), frequencies, 1)
    trainer.model = trainer.model.like(trainer.model.flat() + draw.normal(0, .2, trainer.model.flat().size))
    logs = trainer.model.log_probabilities(contexts, targets)
    assert np.allclose(trainer.model.log_probabilities_of(runs), logs, atol=1e-4)
    noise = trainer.noise()
    for (rows, g), (others, h) in zip(trainer.gradients(contexts, targets, noise),
                                      trainer._mean(runs, len(runs), [noise])):
        assert isinstance(rows, slice) or np.array_equal(rows, others)
        assert np.allclose(g, h, atol=1e-5)
    # noise is dealt by share: a frequency is off by less than one draw at either end
    for drawn, (shares, _) in zip(trainer.noise(), trainer.levels):
        counts = np.bincount(drawn, minlength=len(shares))
        assert np.all(np.abs(counts - B.NOISE * np.diff(shares, prepend=0)) < 2)


def test_coded_texts_by_blocks(spark, monkeypatch):
    """What a text gets does not depend on the texts that are looked up with it."""
    from paddock.llm import lm_scoring as L

    texts = ["a b a", None, "", "C c zz\x1fq qé", " b ", "日本 x" * 40, "new words only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, text string").coalesce(1)
    head = [(b"a", 5), (b"b", 4), (L.END, 4), (b"c", 2)]
    sums = {}
    for w, c in head:
        sums[L.ending(w)] = sums.get(L.ending(w), 0) + c
    lex = L.Lexicon(head, {e: (c, 0) for e, c in sums.items()}, 15, 4)
    assert [len(x) for x in L._together(["abc", None, "", "d" * L.LETTERS, "e"])] == [4, 1]
    got = sorted(L.coded(docs, lex).collect())
    for r, t in zip(got, texts):
        words = L.tokens_of(t)
        known = [w for w in words if w in lex.head]
        assert (r.n_tokens, r.n_head) == (len(words), len(known))
        assert [bytes(w) for w in r.tail] == [w for w in words if w not in lex.head]
        assert r.classes == [lex.head[w][0] if w in lex.head else lex.shift + L.ending(w) for w in words]
        assert abs(r.base - sum(lex.head[w][1] for w in known)) < 1e-12
        assert abs(r.inside - sum(lex.head[w][2] for w in known)) < 1e-12
    monkeypatch.setattr(L, "LETTERS", 1)
    assert sorted(L.coded(docs, lex).collect()) == got
    counted = {bytes(r.word): (r.ending, r.c) for r in L.token_counts(docs).collect()}
    assert all(e == L.ending(w) for w, (e, _) in counted.items()) and counted[L.END][1] == len(texts)


def test_words_of_a_class_sum_to_one():
    import math

    from paddock.llm.lm_scoring import ENDINGS, Lexicon, ending

    words = [(f"w{i}".encode(), 1 + i % 4) for i in range(900)]
    sums = {}
    for w, c in words:
        n, ones = sums.get(ending(w), (0, 0))
        sums[ending(w)] = (n + c, ones + (c == 1))
    lex = Lexicon(sorted(words, key=lambda x: -x[1]), sums, sum(c for _, c in words), 900)
    for e in range(ENDINGS):
        inside = [10 ** t for w, (k, _, t) in lex.head.items() if k == lex.shift + e]
        if inside:
            assert math.isclose(sum(inside) + 10 ** lex.unseen[e], 1, rel_tol=1e-9)


def test_classes_follow_the_distinct_words():
    from paddock.llm import lm_scoring as L
    from paddock.llm import log_bilinear as B

    assert L.OWN >= 384 and L.ENDINGS >= 96 and L.ROUNDS >= 3
    assert B.CONTEXT >= 5 and B.DIM >= 16 and B.NOISE >= 64
    for v, own in ((2_000, 384), (40_000, 800), (1_000_000, 4_000)):
        head = [(f"w{i}".encode(), 9) for i in range(5_000)]
        sums = {e: (10 ** 6, 0) for e in range(L.ENDINGS)}
        lex = L.Lexicon(head, sums, L.ENDINGS * 10 ** 6, v)
        assert len(lex.own) == own + 1 and lex.classes == own + 1 + L.ENDINGS
        assert len({lex.head[w][0] for w, _ in head[:own]}) == own
        assert all(lex.head[w][0] >= lex.shift for w, _ in head[own:])


def test_warc(spark):
    from paddock.llm.warc import archived

    page = "<p>" + "é" * 100 + "</p>"
    rows = [(5, "u", page), (2, "u\r\nx", page), (9, None, page), (1, "v", None), (3, "v", ""), (4, "w", "a" * 99),
            (6, "w", "a" * 99), (7, "z", "WARC/1.0\r\n\r\n" * 30000), (None, "n", "b\r\n" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = {r.id: r for r in archived(df).collect()}
    assert len(got) == len(rows)
    assert got["2"].kind == "response" and {got[k].refers_to for k in ("5", "9")} == {"2"}
    assert got["7"].payload_bytes == 360000 and got["7"].last_chunk == 5
    assert {got[k].kind for k in ("1", "3", "4", "6")} == {"response"} and got[None].payload_bytes == 150
    assert archived(df.limit(0)).count() == 0


def test_quality_classifier(spark, docs, labels):
    from paddock.llm.quality_classifier import fitted, labelled_sample, score_quality

    model = fitted(labelled_sample(docs, labels, F.lit(True)))
    rows = score_quality(docs, model).select("_row.doc_id", "score", "n_passages").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert score_quality(docs.limit(0), model).count() == 0
    unlabelled = fitted(labelled_sample(docs, labels.limit(0), F.lit(True)))
    assert score_quality(docs, unlabelled).count() == docs.count()


def test_fingerprints(spark, docs):
    from paddock.llm.fingerprints import neighbour_fingerprints

    rows = neighbour_fingerprints(docs).collect()
    assert len(rows) == docs.count()
    prints = {r.id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[3] == prints[4]
    one = neighbour_fingerprints(docs.where("doc_id = 1")).collect()
    assert [r.near_next for r in one] == [1.0]
    assert neighbour_fingerprints(docs.limit(0)).count() == 0


def test_spans_and_extensions():
    import os

    from paddock.llm.prefix_hash import PrefixHashes, common_extension

    a, b = "abracadabra", "xxabracadoo"
    x, y = PrefixHashes(a), PrefixHashes(b)
    for i in range(len(a)):
        for j in range(len(b)):
            assert common_extension(x, i, y, j) == len(os.path.commonprefix([a[i:], b[j:]]))
            for k in range(1, 4):
                if i + k <= len(a) and j + k <= len(b):
                    assert (x.span(i, i + k) == y.span(j, j + k)) == (a[i:i + k] == b[j:j + k])


def test_a_repeated_id_gives_one_text_of_the_sample(spark):
    from paddock.llm.quality_classifier import labelled_sample

    docs = spark.range(900).selectExpr("1L doc_id", "concat('text ', id % 7) text").union(
        spark.createDataFrame([(2, None), (3, "other")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    got = {r["_key"]: (r.text, r.y) for r in labelled_sample(docs, labels, F.lit(True)).collect()}
    assert len(got) == 3 and got[1][0].startswith("text ") and got[1][1] == 0
    assert got[2] == ("", 1) and got[3] == ("other", 1)


def test_ranges_of_fingerprints_are_written_at_half_their_length(spark):
    import glob

    from paddock.llm.fingerprints import neighbour_fingerprints
    from paddock.session import shared_dir

    texts = spark.range(40).selectExpr("id as doc_id", "concat_ws(' ', sequence(id, id + 60)) as text")
    before = set(glob.glob(f"{shared_dir(spark).removeprefix("file:")}/ranges-*"))
    assert neighbour_fingerprints(texts).count() == 40
    (folder,) = set(glob.glob(f"{shared_dir(spark).removeprefix("file:")}/ranges-*")) - before
    files = glob.glob(f"{folder}/part-*")
    assert files and all(".zstd." in f for f in files)
