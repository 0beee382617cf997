"""Near duplicates against all pairs, on a large group of edited copies and a passage that many share."""

import random

from paddock.llm.ngram_join import near_duplicates


def test_components_of_all_pairs(spark):
    draw = random.Random(4)

    def words(n):
        return ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n)]

    base, passage, texts = words(90), words(40), []
    for i in range(150):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(len(copy))] = words(1)[0]
        texts.append(" ".join(copy[: draw.randint(80, 90)]))
    texts += [" ".join(words(60) + passage + words(draw.randint(5, 60))) for _ in range(60)]
    texts += texts[:20] + [" ".join(words(3)), "", "x y z", "X y  Z"]
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component) for r in near_duplicates(df).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_positions_leave_out_no_link(spark):
    """Sets that link pass by their first common shingle; sets that differ early do not."""
    from pyspark.sql import functions as F

    from paddock.llm.ngram_join import positions_fit

    draw = random.Random(6)
    rows, links = [], 0
    for _ in range(4000):
        base = draw.sample(range(300), draw.randint(1, 60))
        a, b = ({x for x in base if draw.random() > .08} | {draw.randint(300, 900) for _ in range(draw.randint(0, 4))} for _ in "ab")
        common = a & b
        if not common:
            continue
        order = {x: draw.random() for x in a | b}
        p, q = (sum(order[x] < min(order[y] for y in common) for x in s) for s in (a, b))
        link = 100 * len(common) >= 80 * len(a | b)
        links += link
        rows.append((len(a), p, len(b), q, link))
    df = spark.createDataFrame(rows, "n int, p int, m int, q int, link boolean")
    fit = positions_fit(F.col("n"), F.col("p"), F.col("m"), F.col("q"))
    assert links > 300 and df.where("link").where(~fit).count() == 0
    assert df.where(~fit).count() > 100


def test_parity_bits_leave_out_no_link(spark):
    """Sets that link pass by their parity bits, at any size; sets that share little do not."""
    import numpy as np
    from pyspark.sql import functions as F

    from paddock.llm.ngram_join import parities_fit, parity

    draw = random.Random(8)
    rows, links = [], 0
    for _ in range(600):
        base = [draw.getrandbits(62) for _ in range(draw.choice([1, 6, 40, 300, 3000]))]
        lost = draw.choice([.02, .08, .12, .5])
        a, b = ({x for x in base if draw.random() > lost} | {draw.getrandbits(62)} for _ in "ab")
        link = 100 * len(a & b) >= 80 * len(a | b)
        links += link
        rows.append((len(a), len(b), link, *(parity(np.array(sorted(s), np.int64)).tolist() for s in (a, b))))
    df = spark.createDataFrame(rows, "n int, m int, link boolean, a array<long>, b array<long>")
    fit = parities_fit(F.col("n"), F.col("a"), F.col("m"), F.col("b"))
    assert links > 150 and df.where("link").where(~fit).count() == 0
    assert df.where(~fit).count() > 100


def test_components_end_with_the_stars(spark, monkeypatch):
    """Links that are stars take no round, others none beyond the one that makes them stars."""
    from paddock.llm import components as C

    made, kept = [], C.written
    monkeypatch.setattr(C, "written", lambda df, label: made.append(label) or kept(df, label))
    cases = [([(1, 5), (5, 1), (7, 1), (8, 9), (3, 3)], {1: 1, 5: 1, 7: 1, 8: 8, 9: 8}, 1),
             ([(2, 9), (4, 9)], {2: 2, 4: 2, 9: 2}, 2), ([], {}, 1),
             ([(i, i + 1) for i in range(40)], dict.fromkeys(range(41), 0), 9)]
    for edges, expected, most in cases:
        made.clear()
        found = C.components(spark.createDataFrame(edges, "a long, b long"))
        assert {r.node: r.component for r in found.collect()} == expected
        assert len(made) <= most
