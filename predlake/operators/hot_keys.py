"""J1 / A1 / X1 for hot keys: the fold of one (ce_id, window) in parallel.

A key with more than ``rows`` messages in a window would be one sort in one task. Its
messages are staged once in slices of about ``rows``, ranges of (key, window, time,
position), so that a slice is as large as any other whatever the keys are. The fold is
a finite transducer, and a slice maps the state it starts in to the state it ends in:

* The state is nothing, a pending request ``R`` or a pending response ``S`` (a null-id
  response ``N`` clears a pending ``S`` and changes nothing else).
* After two events of one type in a row the state is that type; after ``S N`` it is
  nothing; both whatever came before. From such an anchor on, events alternate and
  every second one completes a pair. So the end state is nothing or the type of the
  last event, by the parity of the events since the anchor, or since the slice's start
  and the state it starts in.

The maps, one row for each slice, are composed in order. Each slice then gets the event
that was pending before it as its first one, and all slices are folded like keys of
their own, next to all other keys and in the same exchange.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from predlake.functions.barrier import barrier, where
from predlake.functions.headers import header
from predlake.model import HEADER_ID
from predlake.operators.envelope import classify
from predlake.session import scratch_folder

HOT_ROWS = 1_000_000   # messages of one key and window that a task folds; more are sliced
BROADCAST_KEYS = 10_000  # hot keys sent to all tasks at most; more are joined by a shuffle
BUCKETS = 1 << 20      # keys are counted by their hash first: so many counts are shuffled by a task at most
PLACE = ["timestamp", "partition", "offset", "_tie"]
GROUP = ["event_id", "window_start", "_slice"]

# Executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _keys(envelopes: DataFrame, window_start: Column) -> DataFrame:
    return envelopes.withColumn("event_id", header(HEADER_ID)).withColumn("window_start", window_start)


def find_hot_keys(envelopes: DataFrame, window_start: Column, rows: int) -> tuple[DataFrame, int] | None:
    """(event_id, window_start) of keys with more than ``rows`` messages, and all their messages' number; None if there are none.

    Headers and times are read, not bodies. Messages are counted by a hash of their key, which tasks
    combine before the exchange; keys are told apart only in buckets that hold enough for a hot one.
    """
    spark = envelopes.sparkSession
    # the barrier keeps the headers from being read twice, by the filter and behind it
    keyed = where(barrier(_keys(envelopes, window_start).select("event_id", "window_start")), F.col("event_id").isNotNull() & F.col("window_start").isNotNull())
    bucket = F.pmod(F.xxhash64("event_id", "window_start"), F.lit(BUCKETS))
    full = [r["bucket"] for r in keyed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).where(F.col("n") > rows).collect()]
    if not full:
        return None
    full = F.broadcast(spark.createDataFrame([(b,) for b in full], "_bucket long"))
    counts = (keyed.withColumn("_bucket", bucket).join(full, "_bucket", "left_semi").groupBy("event_id", "window_start")
              .agg(F.count("*").alias("n")).where(F.col("n") > rows))
    found = counts.limit(BROADCAST_KEYS + 1).collect()
    if not found:
        return None
    if len(found) <= BROADCAST_KEYS:
        keys = spark.createDataFrame([(r.event_id, r.window_start) for r in found], "event_id string, window_start timestamp")
        return F.broadcast(keys), sum(r.n for r in found)
    return counts.select("event_id", "window_start"), counts.agg(F.sum("n")).first()[0]


def _staged(df: DataFrame) -> DataFrame:
    """Written once under the shared checkpoint folder: slices must not move between the two passes."""
    path = scratch_folder(df.sparkSession, "hot-keys")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slice_maps(staged: DataFrame) -> DataFrame:
    """One row for each slice: what decides its end state, and the places of its last request and response."""
    ev = where(classify(staged), F.col("_reason").isNull())
    kind = F.when((F.col("kind") == "S") & F.col("resp_id").isNull(), F.lit("N")).otherwise(F.col("kind"))
    ev = ev.select(*GROUP, *PLACE, kind.alias("t"))
    part = Window.partitionBy(*GROUP).orderBy(*PLACE)
    before = F.lag("t").over(part)
    ev = (ev.withColumn("_first", before.isNull()).withColumn("_cut", ((F.col("t") == "N") & (before == "S")).cast("int"))
          .withColumn("_seg", F.sum("_cut").over(part.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    starts_null = F.max((F.col("_first") & (F.col("t") == "N"))).alias("starts_null")
    real = ev.where(F.col("t") != "N")
    real = real.withColumn("_prev", F.lag(F.struct("t", "_seg")).over(part)).withColumn("_rn", F.row_number().over(part))
    anchor = ((F.col("_prev.t") == F.col("t")) & (F.col("_prev._seg") == F.col("_seg"))) | (F.col("_prev._seg") != F.col("_seg"))
    place = F.struct("_rn", *PLACE)
    runs = real.groupBy(*GROUP).agg(
        F.count("*").alias("events"), F.max(F.when(anchor, F.col("_rn"))).alias("anchor"), F.max(F.when(F.col("_rn") == 1, F.col("t"))).alias("first"),
        F.max_by("t", "_rn").alias("last"), F.max("_seg").alias("last_seg"),
        F.max(F.when(F.col("t") == "R", place)).alias("last_r"), F.max(F.when(F.col("t") == "S", place)).alias("last_s"))
    whole = ev.groupBy(*GROUP).agg(starts_null, F.max("_seg").alias("end_seg"))
    return whole.join(runs, GROUP, "left").select(
        *GROUP, "starts_null", F.coalesce("events", F.lit(0)).alias("events"), "anchor", "first", "last",
        (F.col("last_seg").isNotNull() & (F.col("end_seg") > F.col("last_seg"))).alias("cleared"),
        # as text: integers with nulls among them would come as floats
        *[F.col(f"last_{k}.{c}").cast("string").alias(f"{k}{c}") for k in "rs" for c in PLACE[1:]],
        *[F.col(f"last_{k}.timestamp").alias(f"{k}timestamp") for k in "rs"])


def end_state(start: str, events: int, anchor: int | None, first: str, last: str, starts_null: bool, cleared: bool) -> str:
    """The transducer's map of a slice; states are "" (nothing pending), "R" and "S"."""
    if cleared:
        return ""
    if starts_null and start == "S":
        start = ""
    if not events:
        return start
    if anchor is not None:
        return last if (events - anchor) % 2 == 0 else ""
    used = start not in ("", first)   # the slice's first event completes the pair of the pending one
    return last if (events % 2 == 1) != used else ""


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """Slices of one key in order -> the place of the event that is pending before each slice, where there is one."""
    pdf = pdf.sort_values("_slice")
    state, last, out = "", {"R": None, "S": None}, []
    for r in pdf.to_dict("records"):
        if state:
            out.append((r["event_id"], r["window_start"], r["_slice"], *last[state]))
        anchor = None if pd.isna(r["anchor"]) else int(r["anchor"])
        state = end_state(state, int(r["events"]), anchor, r["first"], r["last"], bool(r["starts_null"]), bool(r["cleared"]))
        for k in "RS":
            if isinstance(r[f"{k.lower()}_tie"], str):
                last[k] = (r["_slice"], *[r[f"{k.lower()}{c}"] for c in PLACE])
    return pd.DataFrame(out, columns=["event_id", "window_start", "_slice", "_from", *PLACE])


CARRY_DDL = ("event_id string, window_start timestamp, _slice int, _from int, timestamp timestamp, partition string, offset string, _tie string")


def sliced(envelopes: DataFrame, window_start: Column, rows: int) -> DataFrame:
    """Envelopes with ``_slice`` (0 for keys that are not hot), ``_tie`` and ``_carried``, ready for the fold by (key, window, slice).

    The event pending before a slice stands in it once more, marked ``_carried``; it comes first there.
    """
    plain = {"_slice": F.lit(0), "_tie": F.lit(0).cast("long"), "_carried": F.lit(False)}
    hot = find_hot_keys(envelopes, window_start, rows)
    if hot is None:
        return envelopes.withColumns(plain)
    keys, messages = hot
    on = ["event_id", "window_start"]
    keyed = _keys(envelopes, window_start)
    cold = keyed.join(keys, on, "left_anti").drop(*on).withColumns(plain)
    # equal places are told apart by what is sent, so that no number of them makes a slice larger
    mine = keyed.join(keys, on, "left_semi").withColumn("_tie", F.xxhash64("value", "headers", F.monotonically_increasing_id()))
    staged = _staged(mine.repartitionByRange(-(-messages // rows), *on, *PLACE).withColumn("_slice", F.spark_partition_id() + 1))
    carries = F.broadcast(slice_maps(staged).groupBy(*on).applyInPandas(_compose, CARRY_DDL)  # one row for a slice at most
                          .select(*on, F.col("_slice").alias("_to"), F.col("_from").alias("_slice"), "timestamp",
                                  F.col("partition").cast("int").alias("partition"), *[F.col(c).cast("long").alias(c) for c in ("offset", "_tie")]))
    same = [staged[c].eqNullSafe(carries[c]) for c in [*on, "_slice", *PLACE]]
    pending = staged.join(carries, same).select(*[staged[c] for c in staged.columns if c != "_slice"], F.col("_to").alias("_slice"))
    hot_rows = staged.withColumn("_carried", F.lit(False)).unionByName(pending.withColumn("_carried", F.lit(True)))
    return cold.unionByName(hot_rows.drop(*on))
