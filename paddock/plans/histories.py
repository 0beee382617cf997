"""Behaviour sequences of each sample, as of its moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions import epoch_seconds, join_array, pad_array
from paddock.operators.encoding import encode_categories
from paddock.operators.filters import int_ids, valid_ids
from paddock.operators.joins import lookup_join
from paddock.operators.sequences import (
    collect_by_action, point_in_time, recent_stats, sequence_items, union_history_today,
)
from paddock.operators.windows import last_k_history
from paddock.plans import names as N
from paddock.sources.tables import scan_day, scan_days, scan_window, shift_day

PAD = "1"


def action_events(behaviour: DataFrame, run_date: str, actions=("click", "bid"),
                  lag: int = N.VISIBLE_AFTER) -> DataFrame:
    """(user_id, action, ts, clue_id): recent history and all of the run date.

    Of the days before, the last 10 events that every moment of the run date can
    see are kept, and all that come within ``lag`` seconds of midnight: bounded
    per user, and no moment misses one of its last 10.
    """
    window = scan_window(behaviour, run_date, -N.HISTORY_DAYS, 0)
    rows = valid_ids(window.where(F.col("action").isin(*actions)), ["user_id", "clue_id"],
                     above_zero=False)
    cols = ["user_id", "action", "ts", "clue_id"]
    # users that are not numbers cannot be joined to a sample
    rows = int_ids(rows, ["user_id", "ts", "clue_id"]).where(F.col("user_id").isNotNull())
    before = scan_window(rows, run_date, -N.HISTORY_DAYS, -1)
    midnight = F.unix_timestamp(F.lit(run_date), "yyyy-MM-dd")
    late = F.coalesce(F.col("ts") >= midnight - lag, F.lit(False))
    history = last_k_history(before.where(~late), N.SEQ_LENGTH, by=("user_id", "action"))
    late_or_today = before.where(late).unionByName(scan_day(rows, run_date))
    return union_history_today(history.select(*cols), late_or_today.select(*cols))


def order_events(orders: DataFrame, run_date: str, since: str | None = None) -> DataFrame:
    """Orders of the 90 days before the run date (or from a day on), as events."""
    made = F.substring("create_time", 1, 10)
    rows = orders.where(
        made.between(since or shift_day(run_date, -N.ORDER_DAYS), shift_day(run_date, -1))
        & F.col("user_id").isNotNull() & F.col("clue_id").isNotNull())
    return rows.select(
        F.col("user_id").cast("int").alias("user_id"), F.lit("contract").alias("action"),
        epoch_seconds("create_time").cast("int").alias("ts"),
        F.col("clue_id").cast("int").alias("clue_id"))


def events_between(behaviour: DataFrame, orders: DataFrame, start: str, end: str,
                   actions=("click", "bid"), lag: int = N.VISIBLE_AFTER) -> DataFrame:
    """(user_id, action, ts, clue_id, seen): all events that some moment of the days can see.

    ``seen`` is the second after which an event is visible: ``lag`` seconds later,
    and for orders not before the day after.
    """
    rows = scan_days(behaviour, shift_day(start, -N.HISTORY_DAYS), end)
    rows = valid_ids(rows.where(F.col("action").isin(*actions)), ["user_id", "clue_id"], above_zero=False)
    rows = int_ids(rows, ["user_id", "ts", "clue_id"]).where(F.col("user_id").isNotNull())
    seen = (F.col("ts") + lag).cast("bigint")
    made = order_events(orders, end, shift_day(start, -N.ORDER_DAYS))
    next_day = F.unix_timestamp(F.date_add(F.timestamp_seconds("ts").cast("date"), 1).cast("timestamp"))
    return rows.select("user_id", "action", "ts", "clue_id", seen.alias("seen")).unionByName(
        made.select("user_id", "action", "ts", "clue_id", F.greatest(seen, next_day - 1).alias("seen")))


def sequence_attributes(priced: DataFrame, dictionary: DataFrame, on=("clue_id",)) -> DataFrame:
    """(clue_id, encoded categories, measures): what a sequence shows of an item (on a day)."""
    sparse = [c for c in N.SEQ_SPARSE if c != "clue_id"]
    rows = priced.select(*on, *sparse, *N.SEQ_DENSE)
    specs = {c: N.SEQ_DICTIONARY.get(c, c) for c in sparse}
    return encode_categories(rows, specs, dictionary, key=list(on))


def _spine(moments: DataFrame) -> DataFrame:
    kinds = F.explode(F.array(*[F.lit(a) for a in N.SEQ_ACTIONS]))
    return moments.select("user_id", "ts").distinct().select("user_id", kinds.alias("action"), "ts")


def history_rows(moments: DataFrame, events: DataFrame, k: int = N.SEQ_LENGTH,
                 lag: int = N.VISIBLE_AFTER) -> DataFrame:
    """(user_id, action, ts, rn, dt, clue_id): the last ``k`` events of each moment of any day.

    Each moment looks back as far as a job of its own day would: the days before it
    count from the day of its second (``dt``).  One pass serves all days.
    """
    day = F.timestamp_seconds("ts").cast("date")
    back = F.when(F.col("action") == "contract", N.ORDER_DAYS).otherwise(N.HISTORY_DAYS)
    spine = _spine(moments).withColumn(
        "since", F.unix_timestamp(F.date_sub(day, back).cast("timestamp")))
    rows = point_in_time(spine, events, by=("user_id", "action"), k=k, lag=lag, floor="since", seen="seen")
    return rows.select("user_id", "action", "ts", "rn", day.cast("string").alias("dt"), "clue_id")


def sequence_features(moments: DataFrame, events: DataFrame, attributes: DataFrame,
                      k: int = N.SEQ_LENGTH, lag: int = N.VISIBLE_AFTER) -> DataFrame:
    """(user_id, ts, arrays..., realtime statistics): one row per moment with history.

    The three kinds of event are one pass: the kind is part of the key until
    the arrays are built, which takes one aggregation per moment.
    """
    rows = point_in_time(_spine(moments), events, by=("user_id", "action"), k=k, lag=lag)
    return sequence_arrays(rows.drop("event_ts"), attributes)


def sequence_arrays(rows: DataFrame, attributes: DataFrame, on=("clue_id",)) -> DataFrame:
    """The arrays and statistics of ranked history rows, with the attributes of their items."""
    rows = sequence_items(rows, attributes, list(on))
    cols = [*N.SEQ_SPARSE, *N.SEQ_DENSE]
    nested = collect_by_action(rows, ["user_id", "ts"], "rn", cols, N.SEQ_ACTIONS)
    out = []
    for a in N.SEQ_ACTIONS:
        out += [F.col(f"{a}.{c}").alias(N.seq_name("s", a, n)) for c, n in N.SEQ_SPARSE.items()]
        out += [F.col(f"{a}.{c}").alias(N.seq_name("d", a, n)) for c, n in N.SEQ_DENSE.items()]
    wide = nested.select("user_id", "ts", *out)
    clicked = {N.seq_name("d", "click", N.SEQ_DENSE[m]): name for m, name in N.REALTIME.items()}
    return recent_stats(wide, clicked, keep=wide.columns)


def sample_sequences(samples: DataFrame, events: DataFrame, attributes: DataFrame,
                     as_text: bool = False, drop_nulls: bool = False,
                     keys_from: DataFrame | None = None) -> DataFrame:
    """Samples with padded sparse sequences, dense sequences and statistics.

    Sparse sequences always have 10 elements; dense ones keep their length and
    are padded by preprocessing.  ``as_text`` gives comma text, in which null
    elements vanish; ``drop_nulls`` does the same to the arrays.  ``keys_from``
    is the narrow sample table, where ``samples`` already carries features.
    """
    keys = samples if keys_from is None else keys_from
    return with_sequences(samples, sequence_features(keys, events, attributes), as_text, drop_nulls)


def with_sequences(samples: DataFrame, seqs: DataFrame, as_text: bool = False,
                   drop_nulls: bool = False) -> DataFrame:
    """Samples of any days with the sequences of their moments."""
    wide = samples.join(seqs, ["user_id", "ts"], "left")
    out = [F.col(c) for c in samples.columns]
    stats = [c for c in seqs.columns if c.startswith("d_u_")]
    for a in N.SEQ_ACTIONS:
        for n in N.SEQ_SPARSE.values():
            name = N.seq_name("s", a, n)
            c = pad_array(name, N.SEQ_LENGTH, PAD, "int")
            out.append((join_array(c) if as_text else c).alias(name))
        for n in N.SEQ_DENSE.values():
            name = N.seq_name("d", a, n)
            c = F.col(name)
            if as_text:
                c = join_array(c)
            elif drop_nulls:
                c = F.array_compact(c)
            out.append(c.alias(name))
        if a == "click":
            out += [F.col(c) for c in stats]
    return wide.select(*out)
