"""The operators on the test tables: ``QUERIES`` by name, and ``ORACLES`` where SQL says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules")
def op1(spark, sf_dir):
    """Base measures, n-gram score and verdict of every document."""
    from paddock.llm.quality_rules import quality_rules, ratios_from_labels

    docs = table(spark, sf_dir, "documents")
    ratios = ratios_from_labels(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, ratios).select(
        "_row.doc_id", "_quality.n_words", "_quality.word_chars", "_quality.n_symbols",
        "_quality.n_dup_lines", "_quality.n_repeat_words", "_quality.base_failed",
        "_quality.kept", "_quality.score")


@query("op2_line_dedup")
def op2(spark, sf_dir):
    """The text left of every document, and how many lines it lost."""
    from paddock.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents")).select(
        "_row.doc_id", "_lines.text", "_lines.n_lines", "_lines.n_deleted", "_lines.emptied")


@query("op6_ngram_jaccard_join")
def op6(spark, sf_dir):
    """Set size and component of every document."""
    from paddock.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op3_mixing")
def op3(spark, sf_dir):
    """Category, weight, probability and draw of every document."""
    from paddock.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("_row.doc_id", "_mix.*")


#: The public vocabulary the queries encode with.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op8_sentencepieces")
def op8(spark, sf_dir):
    """Pieces and n best scores of every document."""
    from paddock.llm.piece_lattice import Pieces
    from paddock.llm.sentencepieces import encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, Pieces.load(PIECES)).select(
        "_row.doc_id", "ids", "n_pieces", "scores", "digests", "others", "round_trip")


@query("op4_lm_scoring")
def op4(spark, sf_dir):
    """Unigram and model scores of every document."""
    from paddock.llm.lm_scoring import score_texts

    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return score_texts(table(spark, sf_dir, "documents"), held_out)


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    """Quality score of every document."""
    from paddock.llm.quality_classifier import THRESHOLD, fitted, labelled_sample, score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = fitted(labelled_sample(docs, table(spark, sf_dir, "labels"), ~held_out))
    return score_quality(docs, model).select("_row.doc_id", "score", "n_passages", "attention").select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "attention")


@query("op10_fingerprints")
def op10(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and their likeness."""
    from paddock.llm.fingerprints import neighbour_fingerprints

    return neighbour_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op5_warc")
def op5(spark, sf_dir):
    """Every page written to archives and read back."""
    from paddock.llm.warc import archived

    return archived(table(spark, sf_dir, "pages")).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"), "last_chunk")


ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to,
       CAST(CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 0
                 ELSE greatest((payload_bytes + 65535) // 65536 - 1, 0) END AS INTEGER) AS last_chunk
FROM f
"""


@query("op9_html_extraction")
def op9(spark, sf_dir):
    """Main text of every page."""
    from paddock.llm.html_extraction import labeller, main_text

    pages = table(spark, sf_dir, "pages")
    return main_text(pages, labeller(pages)).select(
        "_row.page_id", "_row.url", "text", "n_chars", "n_blocks", "n_main")


@query("op11_filter_audit", r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM w),
m AS (SELECT bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic, doc_id AS labelled FROM labels GROUP BY doc_id),
d AS (SELECT part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails,
  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN m ON doc_id = labelled),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS ng, count(*) FILTER (toxic) AS nt FROM d GROUP BY ALL),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, i AS step,
  o[i] AS own, o[1:i - 1] AS before FROM o, l),
t AS (SELECT part, filter_order, step, own, fails[own] AS hit,
  len(list_filter(before, lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) = 1 AS single, n, ng, nt
  FROM g, s),
r AS (SELECT part, filter_order, step, own,
  sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN hit AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN hit AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN hit AND NOT gone THEN ng ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN hit AND NOT gone THEN nt ELSE 0 END)::BIGINT AS toxic_lost FROM t GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
""")
def op11(spark, sf_dir):
    """What five filters remove, in every order, per source."""
    from paddock.llm.filter_audit import audit, judged

    return audit(judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: The public byte-level vocabulary the queries encode with.
BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.json"


@query("op12_byte_bpe")
def op12(spark, sf_dir):
    """Ids of every document, decoded again."""
    from paddock.llm.byte_bpe import Shared, decode, encode
    from paddock.llm.pair_merges import Merges

    shared = Shared(spark, Merges.load(BYTE_PAIRS))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, shared).select("_row.doc_id", "n_tokens", "ids_sha256", "ids")
    return decode(encoded, shared).select("_row.*", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_lexical_search", r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, docs),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, cast(row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM r WHERE score > 0) WHERE rank <= 10
""")
def op13(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    from paddock.llm.lexical_search import best_documents

    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
