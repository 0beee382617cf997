"""WARC archives of a table, written and read as a table of record chunks.

Writing: every payload gets its digest, equal payloads of ``SMALLEST`` bytes or
more one response (the smallest id) and revisits that refer to it.  Spark's own
text writer puts the records down (a record is one value, its end the line
separator), so files are committed whole when a task is run again.

Reading: each archive is streamed by one task and comes out as a chunk table,
(record, number, data, bytes so far, digest so far).  A payload of any size
passes in chunks of 64 KiB; its digest and length are those of its last chunk,
and a projection without ``data`` moves a few bytes per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import scratch, written
from paddock.llm.warc_stream import Reader

SMALLEST = 100
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"


def records(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``id``, ``url``, ``data`` (binary), ``bytes``, ``digest``, ``kind``, ``refers_to``.

    A text is stored in UTF-8; null is empty.  Only digests are grouped and
    joined: sums per task first, then one row per digest that comes twice, so a
    payload that a third of all rows share moves as its digest only.
    """
    rows = df.select(df[f"`{key}`"].cast("long").alias("id"), df[f"`{url}`"].cast("string").alias("url"),
                     F.coalesce(df[f"`{payload}`"].cast("binary"), F.lit(b"")).alias("data"))
    rows = rows.withColumns({"bytes": F.length("data").cast("long"), "digest": F.sha2("data", 256)})
    narrow = rows.where(F.col("bytes") >= SMALLEST).select("digest", "id")
    twice = written(narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", "first"), "twice")
    again = written(narrow.join(twice, "digest").where("id is null or id != first").select(
        "id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits")
    return rows.join(again.hint("shuffle_hash"), ["id", "digest"], "left").withColumn(
        "kind", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def record_id(name):
    return F.concat(F.lit("urn:record:"), F.coalesce(name.cast("string"), F.lit("none")))


def write_warc(rows: DataFrame, path: str) -> None:
    """Write :func:`records` as archives below ``path``.

    A revisit has no block.  Breaks of line in a url are taken out, since a
    header is one line.
    """
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    block = F.when(F.col("kind") == "revisit", F.lit(b"")).otherwise(F.col("data"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", " ")
    profile = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
    refers = F.when(F.col("refers_to").isNull(), F.lit("")).otherwise(F.concat(
        F.lit("WARC-Refers-To: <"), record_id(F.col("refers_to")), F.lit(f">{CRLF}WARC-Profile: {profile}{CRLF}")))
    header = F.concat(
        F.lit(f"WARC/1.0{CRLF}"), line("WARC-Type", F.col("kind")),
        F.lit("WARC-Record-ID: <"), record_id(F.col("id")), F.lit(f">{CRLF}"), refers,
        line("WARC-Target-URI", url), line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.length(block).cast("string")), F.lit(CRLF))
    # bytes pass through as they are: a cast to string does not change them
    whole = F.concat(header.cast("binary"), block, F.lit(CRLF.encode())).cast("string").alias("value")
    rows.select(whole).write.option("lineSep", CRLF).option("compression", "gzip").text(path)


CHUNKS = ("archive string, record string, kind string, url string, refers_to string, said_digest string, "
          "said_bytes long, place long, number int, data binary, bytes long, digest string, last boolean")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of all archives below ``path``; one task streams one archive at a time.

    Spark lists the files (their content is not read by it); the tasks open
    them through Arrow's file systems, which follow the path's scheme.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("path")
    files = files.repartition(spark.sparkContext.defaultParallelism * 4, F.xxhash64("path"))

    def run(batches):
        import re

        import pyarrow as pa
        from pyarrow import fs

        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
        fields = [f.split() for f in CHUNKS.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])

        for b in batches:
            for name in b.column(0).to_pylist():
                system, where = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                with system.open_input_stream(where, compression="gzip" if name.endswith(".gz") else None) as stream:
                    rows, held = [], 0
                    for place, (h, chunks) in enumerate(Reader(stream).records()):
                        size = int(h["content-length"])
                        for number, data, done, digest in chunks:
                            refers = h.get("warc-refers-to")
                            rows.append((name, h["warc-record-id"][1:-1], h["warc-type"], h.get("warc-target-uri"),
                                         refers and refers[1:-1], h.get("warc-payload-digest", "")[7:],
                                         int(h.get("x-payload-length", size)), place, number, data, done, digest, done == size))
                            held += len(data) + 300
                            if held > 1 << 22:
                                yield batch(rows)
                                rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return files.mapInArrow(run, CHUNKS)


def archived(df: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write ``df`` as archives and read them back: one row per record.

    ``id`` (as text), ``payload_bytes``, ``payload_digest``, ``kind`` and
    ``refers_to``.  Length and digest of a response are those of the payload that
    was read; a revisit has no payload and gives those of its header.  Rows
    without an id or with the same id are records of their own; an empty table
    gives an empty one.
    """
    spark = df.sparkSession
    path = path or scratch(spark, "warc")
    write_warc(records(df, **columns), path)
    ends = read_warc(spark, path).where("last")
    said = F.col("kind") == "revisit"

    def name(c):
        return F.nullif(F.regexp_replace(c, "^urn:record:", ""), F.lit("none"))

    return ends.select(
        name("record").alias("id"), F.when(said, F.col("said_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(said, F.col("said_digest")).otherwise(F.col("digest")).alias("payload_digest"), "kind",
        name("refers_to").alias("refers_to"), F.col("number").alias("last_chunk"))
