"""Five stages from raw documents to pieces: filter, cut repeats, one of each group, mix, encode.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
a DataFrame; the driver of the pipeline writes it as Parquet and reads it again
for the next one.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import written
from paddock.llm.line_dedup import line_dedup
from paddock.llm.mixing import mix
from paddock.llm.ngram_join import near_duplicates
from paddock.llm.piece_lattice import Pieces
from paddock.llm.quality_rules import quality_rules, ratios_from_labels
from paddock.llm.queries import PIECES
from paddock.llm.sentencepieces import encode
from paddock.operators.joins import lookup_join

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram score; the others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules(_documents(docs), ratios_from_labels(docs, labels))
    return judged.where("_quality.kept").select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that repeat earlier ones; documents with nothing left go."""
    cut = line_dedup(_documents(docs)).where("not _lines.emptied")
    changed = F.col("_lines.n_deleted") > 0
    return cut.select(
        "_row.doc_id", "_lines.text", "_row.lang", "_row.source",
        F.when(changed, F.length("_lines.text").cast("long")).otherwise(
            F.col("_row.n_chars")).alias("n_chars"))


def _own_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``near_id``, an id for each row's text: ``doc_id`` where it has one text.

    Texts that share an id get ids beyond all others, so a text under an id of its own
    is kept in place of the same one under a shared id.
    """
    text = F.xxhash64("text")
    shared = docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(text).alias("low"), F.max(text).alias("high")).where("low < high").select("doc_id")
    shared = written(shared, "shared-ids")
    if shared.isEmpty():
        return docs.withColumn("near_id", F.col("doc_id"))
    beyond = F.pmod(F.xxhash64("doc_id", text), F.lit(1 << 61)) + F.lit(1 << 62)
    marked = lookup_join(docs, shared.withColumn("several", F.lit(True)), "doc_id")
    return marked.select(*COLUMNS, F.when(F.col("several"), beyond).otherwise(F.col("doc_id")).alias("near_id"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the smallest id; rows without an id stay.

    Rows go by their own text: another text under the id of a copy is no copy.
    """
    rows = _own_ids(_documents(docs))
    copies = near_duplicates(rows, "near_id").where("component != id").select(F.col("id").alias("near_id")).distinct()
    return rows.join(copies.hint("shuffle_hash"), "near_id", "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which source, language and topic meet their target weights."""
    return mix(_documents(docs)).where("_mix.taken").select("_row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with its n best scores."""
    return encode(docs.select("doc_id", "text"), Pieces.load(PIECES)).select(
        "_row.doc_id", "ids", "n_pieces", "scores", "round_trip")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near),
    ("mixing", mixture),
    ("sentencepieces", pieces),
]

#: Winnowing with first copies, components, raking and lattice search are not SQL;
#: tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
