"""The pipeline's stages on a small table: what goes, what stays, and the columns."""

import random

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)

    def words(n):
        return [f"{''.join(draw.choices('abcdefghij', k=5))}" for _ in range(n)]

    def text(n=60):
        return "\n".join(" ".join(words(15)) for _ in range(n // 15))

    first, second = text(), text()
    rows = [(1, first, "en", "a"), (5, first, "en", "a"), (5, second, "en", "b"), (6, "too short", "en", "a"),
            (7, None, None, None), (8, " ".join(["again"] * 90), "fr", "b")]
    rows += [(10 + i, text(), draw.choice(["en", "fr"]), draw.choice("abc")) for i in range(40)]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_near_copies_go_by_row_and_not_by_id(spark, corpus):
    kept = pipeline.near(spark, corpus, "")
    assert kept.columns == list(pipeline.COLUMNS)
    left = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    gone = (5, rows[0][1])
    assert left == sorted(str(r) for r in rows if r != gone) and gone in rows
    # the same texts again under ids of their own: those stay, whatever the shared id is
    more = corpus.where("doc_id = 5").withColumn("doc_id", F.length("text").cast("long") + 900)
    again = {(r.doc_id, r.text) for r in pipeline.near(spark, corpus.union(more), "").collect()}
    assert {t for _, t in again} == {t for _, t in rows} and not any(i == 5 for i, _ in again)


def test_ids_of_their_own_need_no_change(spark, corpus):
    once = corpus.where("doc_id <> 5")
    assert sorted(map(str, pipeline.near(spark, once, "").collect())) == sorted(map(str, once.collect()))
    assert pipeline.near(spark, corpus.limit(0), "").count() == 0
    none = corpus.withColumn("doc_id", F.lit(None).cast("long"))
    assert pipeline.near(spark, none, "").count() == corpus.count()


def test_stages_follow_each_other(spark, corpus, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(10 + i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    corpus.write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = []
    for name, stage in pipeline.STAGES:
        out = f"{sf}/{name}"
        stage(spark, docs, sf).write.parquet(out)
        docs = spark.read.parquet(out)
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "sentencepieces":
            assert docs.columns == list(pipeline.COLUMNS)
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "mixing", "sentencepieces"]
    assert all(a >= b for a, b in zip(ids, ids[1:])) and {6, 7, 8}.isdisjoint(ids[0]) and ids[-1]
    assert docs.where("not round_trip").count() == 0
    assert sorted(r.doc_id for r in pipeline.run(spark, sf).collect()) == sorted(r.doc_id for r in docs.collect())
