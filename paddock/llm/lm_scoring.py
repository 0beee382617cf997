"""Log10 probabilities of texts by a log-bilinear model over word classes.

Tokens are lower-cased words and one end per text.  The most frequent words and
the end are classes of their own: ``OWN`` of them at least, and four times the
square root of the distinct training words where that is more (:func:`own_words`).
Every other word is in the class of its last two characters (``ENDINGS`` by hash).  A token's probability is that of
its class after the classes before it (:mod:`paddock.llm.log_bilinear`) times
that of the word in its class: c / n of what the class leaves for words never
seen, which is the share of its words seen once (all unseen words of a class
are one event).  So the probabilities of all tokens after any context sum to 1.

Spark counts every training token; counts of the ``HEAD`` most frequent words
(a bounded list) go to the tasks, all others meet their counts in a join.  The
model trains on every training text: in each of ``ROUNDS`` rounds all partitions
go on from the same weights over their own texts, and the weights are averaged
by tokens in Spark.  Weights grow with the classes; texts and counts stay distributed.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import written
from paddock.llm.log_bilinear import BATCH, RUN, Model, Trainer, runs_of

OWN, ENDINGS, HEAD, ROUNDS = 384, 96, 50_000, 3
#: Weights that a row holds on their way to the mean.
BLOCK = 8_192
#: Characters of texts whose words are looked up at once.
LETTERS = 1 << 19
END = b"\n"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens_of(text: str | None) -> list[bytes]:
    """Words parted at ``[\\x20\\x09-\\x0D]`` (what bytes.split does), then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    words.append(END)
    return words


def own_words(v: int) -> int:
    """How many words get a class of their own, of ``v`` distinct ones."""
    return max(OWN, 4 * math.isqrt(v))


def ending(word: bytes) -> int:
    """The class, from 0, of a word that has none of its own."""
    return zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % ENDINGS


def ending_of(word: str) -> Column:
    """:func:`ending` of a column of words."""
    last = F.right(F.decode(word, "UTF-8"), F.lit(2))
    return F.pmod(F.crc32(F.encode(last, "UTF-8")), F.lit(ENDINGS)).cast("int")


def token_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``ending`` and ``c`` for every token of ``text``; counted in each task first."""

    def run(batches):
        import pyarrow as pa

        def rows(counted):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())], ["word", "c"])

        counted: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                counted.update(tokens_of(t))
                if len(counted) > 400_000:
                    yield rows(counted)
                    counted.clear()
        yield rows(counted)

    counts = docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    return counts.select("word", ending_of("word").alias("ending"), "c")


class Lexicon:
    """What the tasks know of words: class and count of the most frequent, sums by ending."""

    def __init__(self, head: list, endings: dict, n: int, v: int):
        own = [w for w, _ in head if w != END][:own_words(v)]
        self.own = {w: i for i, w in enumerate(own)}
        self.own[END] = len(own)
        self.shift = len(own) + 1
        self.classes = self.shift + ENDINGS
        self.n, self.v = n, v
        counts = dict(head)
        counts.setdefault(END, 0)
        left = {e: list(endings.get(e, (0, 0))) for e in range(ENDINGS)}
        for w in own:
            left[ending(w)][0] -= counts[w]
            left[ending(w)][1] -= counts[w] == 1
        if END in dict(head):
            left[ending(END)][0] -= counts[END]
            left[ending(END)][1] -= counts[END] == 1
        #: per ending: tokens of its class, and the log10 share of words never seen
        self.size = [left[e][0] for e in range(ENDINGS)]
        unseen = [(s + 0.5) / (t + 1) if t else 1.0 for t, s in (left[e] for e in range(ENDINGS))]
        self.unseen = [math.log10(u) for u in unseen]
        self.seen = [math.log10((1 - u) / t) if t else 0.0 for u, t in zip(unseen, self.size)]
        frequencies = np.ones(self.classes)
        for w, i in self.own.items():
            frequencies[i] += counts[w]
        frequencies[self.shift:] += np.maximum(self.size, 0)
        self.frequencies = frequencies / frequencies.sum()
        #: word: class, base term, log10 probability in its class
        self.head = {w: self._entry(w, counts[w]) for w in counts}

    def _entry(self, word, c):
        base = math.log10((c + 1) / (self.n + self.v + 1))
        if word in self.own:
            return self.own[word], base, 0.0
        e = ending(word)
        return self.shift + e, base, self.seen[e] + math.log10(c)


def lexicon(counts: DataFrame) -> Lexicon:
    """From the written counts; ``HEAD`` words, or all that are classes, and ``ENDINGS`` sums reach the driver."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("c"), "word").limit(max(HEAD, own_words(v) + 1)).collect()
    sums = counts.groupBy("ending").agg(F.sum("c"), F.count_if(F.col("c") == 1)).collect()
    return Lexicon([(bytes(r.word), r.c) for r in head], {r[0]: (r[1], r[2]) for r in sums}, n, v)


CODED = ("n_tokens long, n_head long, base double, inside double, classes array<int>, "
         "tail array<binary>")


def coded(rows: DataFrame, words: Lexicon) -> DataFrame:
    """Per text its classes, the sums of its head words, and its other words."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        import pyarrow as pa

        lex = shared.value
        place = {w: i for i, w in enumerate(lex.head)}.get
        # a word that is not there has place -1, the last entry
        classes_at, base_at, inside_at = map(np.array, zip(*lex.head.values(), (0, 0.0, 0.0)))
        for b in batches:
            texts, done = b.column(b.num_columns - 1), 0
            for together in _together(texts.to_pylist()):
                found = list(map(tokens_of, together))
                words = list(chain.from_iterable(found))
                at = np.fromiter(map(place, words, repeat(-1)), np.intp, len(words))
                others = np.flatnonzero(at < 0)
                tail = [words[i] for i in others.tolist()]
                classes = classes_at[at].astype(np.int32)
                classes[others] = [lex.shift + ending(w) for w in tail]
                ends = np.cumsum([0, *map(len, found)])
                known, base, inside = (np.add.reduceat(x, ends[:-1]) for x in (
                    (at >= 0).astype(np.int64), base_at[at], inside_at[at]))
                lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), v) for e, v in (
                    (ends, pa.array(classes)), (ends - np.append(0, np.cumsum(known)), pa.array(tail, pa.binary())))]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(done, len(together)) for c in b.columns[:-1]]
                    + [pa.array(np.diff(ends)), pa.array(known), pa.array(base), pa.array(inside), *lists],
                    list(b.schema.names[:-1]) + [f.split()[0] for f in CODED.split(", ")])
                done += len(together)

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join(kept) + ", " + CODED)


def _together(texts: list) -> Iterator[list]:
    """The texts in their order, as many at once as have ``LETTERS`` characters, one at least."""
    some, letters = [], 0
    for t in texts:
        some.append(t)
        letters += len(t or "")
        if letters >= LETTERS:
            yield some
            some, letters = [], 0
    if some:
        yield some


def _texts(column) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.int64)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _mean(table):
    """The mean of one block of weights, by tokens; a group has one row from each task."""
    import pyarrow as pa

    total, tokens = 0.0, 0
    for b in table.to_batches():
        for n, weights in zip(b.column("n").to_pylist(), b.column("weights")):
            total = total + np.frombuffer(weights.as_buffer(), np.float32).astype(np.float64) * n
            tokens += n
    mean = (total / tokens).astype(np.float32).tobytes()
    return pa.table({"block": table.column("block").slice(0, 1), "weights": pa.array([mean], pa.binary())})


def trained(texts: DataFrame, frequencies: np.ndarray, rounds: int = ROUNDS) -> Model:
    """A model of ``classes``, over every row in every round."""
    model = Model.fresh(frequencies)
    context = texts.sparkSession.sparkContext
    for turn in range(rounds):
        shared = context.broadcast((model, frequencies))

        def run(batches, turn=turn, shared=shared):
            import pyarrow as pa

            start, freq = shared.value
            trainer, tokens, rest = Trainer(start, freq, turn + 1), 0, None
            each = BATCH // RUN
            for b in batches:
                for a in range(0, b.num_rows, 256):
                    texts = _texts(b.column(0).slice(a, 256))
                    tokens += sum(map(len, texts))
                    runs = runs_of(texts, len(freq))
                    runs = np.concatenate([runs[:0] if rest is None else rest, runs])
                    order = trainer.draw.permutation(len(runs))
                    whole = len(order) - len(order) % each
                    for x in range(0, whole, each):
                        trainer.step(runs[order[x:x + each]])
                    rest = runs[order[whole:]]
            if rest is not None and len(rest):
                trainer.step(rest)
            if tokens:
                flat = trainer.model.flat()
                blocks = [flat[a:a + BLOCK].tobytes() for a in range(0, len(flat), BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(blocks)), pa.int32()), pa.array([tokens] * len(blocks), pa.int64()),
                     pa.array(blocks, pa.binary())], ["block", "n", "weights"])

        parts = texts.select("classes").mapInArrow(run, "block int, n long, weights binary")
        means = parts.groupBy("block").applyInArrow(_mean, "block int, weights binary").collect()
        if not means:
            return model
        model = model.like(np.frombuffer(b"".join(r.weights for r in sorted(means)), np.float32))
    return model


def _neural(rows: DataFrame, model: Model) -> DataFrame:
    """``row`` and ``outside``, the log10 probability of its classes."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        model = shared.value
        for b in batches:
            sums = []
            for a in range(0, b.num_rows, 256):
                texts = _texts(b.column(1).slice(a, 256))
                logs = model.log_probabilities_of(runs_of(texts, len(model.outputs)))
                sums.append(np.add.reduceat(logs, np.cumsum([0] + [len(t) for t in texts[:-1]])))
            done = np.concatenate(sums) / math.log(10) if sums else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done)], ["row", "outside"])

    return rows.select("row", "classes").mapInArrow(run, "row long, outside double")


def score_texts(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` for every row of ``df``.

    Learns from the rows where ``held_out`` is false.  A null or empty text is
    one end; repeated rows are counted as often as they come and score alike;
    without training rows both scores still exist (every word is unseen); an
    empty table gives an empty one.
    """
    docs = df.select(df[f"`{key}`"].alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                     df[f"`{text}`"].alias("text"))
    counts = written(token_counts(docs.where("not held_out")), "counts")
    words = lexicon(counts)
    rows = written(coded(docs, words).withColumn("row", F.monotonically_increasing_id()), "coded")
    model = trained(rows.where("not held_out"), words.frequencies)
    # words outside the head: their counts come by a join, their sums go back by row
    tail = rows.select("row", F.explode("tail").alias("word")).join(
        counts.select("word", "c", "ending").hint("shuffle_hash"), "word", "left")
    tail = tail.withColumn("e", F.coalesce("ending", ending_of("word")))
    seen, unseen = (F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("e"))
                    for values in (words.seen, words.unseen))
    known = F.col("c").isNotNull()
    sums = tail.groupBy("row").agg(
        F.count_if(known).alias("tail_known"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(words.n + words.v + 1)))).alias("tail_base"),
        F.sum(F.when(known, seen + F.log10("c")).otherwise(unseen)).alias("tail_inside"))
    zero = F.lit(0.0)
    done = rows.drop("classes", "tail").join(_neural(rows, model), "row").join(sums, "row", "left")
    head_known = F.col("n_head") if words.n else F.lit(0)
    return done.select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (head_known + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("outside") + F.col("inside") + F.coalesce("tail_inside", zero)).alias("score"))
