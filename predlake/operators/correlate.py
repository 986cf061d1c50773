"""Pair each KServe request with its response (batch).

Only usable events are paired: a refused message (bad body, bad or missing
time) leaves the pending state as it was and goes to the quarantine.

Semantics (per CloudEvent id and tumbling window of the message timestamp,
events ordered by ``(timestamp, partition, offset)``): a request sets the
pending request, a response sets the pending response (a repeat overwrites,
last write wins); as soon as both are pending and the response has an ``id``,
the pair is emitted and both are cleared. A response whose ``id`` is JSON
null is pending but can never complete.

Instead of collecting each group and folding it (one row holding a whole
group), the fold is rewritten as window functions over one hash partitioning
on ``(ce_id, window)``, so a group is streamed in order by ``WindowExec``
(which spills) and nothing is collected:

* A null-id response ``N`` only matters right after a response ``S``: it
  clears it, which is the same as starting the group afresh. Every other
  ``N`` is a no-op. So ``S``-``N`` steps cut the group into segments and all
  ``N`` are dropped.
* In a segment of ``R``/``S`` events, cut into runs of one type, a pair can
  only be emitted where a run ends: (last event of run i, first event of run
  i+1). Run boundary i emits unless run i has length 1 and its only event was
  used up as the closer of boundary i-1. Hence, with the *head* of a run the
  latest run at or before it that is first in its segment or not of length
  1, boundary i emits exactly when ``run_index(i) - run_index(head)`` is even.

All passes share one partitioning and ordering: one shuffle, one sort. Keys
with very many messages are cut into slices that are folded side by side
(:mod:`predlake.operators.hot_keys`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from predlake.functions.barrier import barrier, where
from predlake.model import DEFAULT_WINDOW
from predlake.operators.envelope import classify
from predlake.operators.hot_keys import HOT_ROWS, sliced
from predlake.operators.prefilter import keep_wanted, wanted_keys

_EVENT = ["event_id", "kind", "resp_id", "model_name", "model_version", "occurred_at", "frame",
          "topic", "partition", "offset", "timestamp"]


def _window_start(window: str):
    """Tumbling window start, floor of the micros (NULL-safe, no row filter)."""
    from predlake.streaming.correlate import _interval_ms
    us = _interval_ms(window) * 1000
    return F.timestamp_micros(F.floor(F.unix_micros(F.col("timestamp")) / us) * us)


def _keyed_events(events: DataFrame, window: str) -> DataFrame:
    """Events with the grouping key and kind ``t`` (R, S, N = response with a null id).

    Refused envelopes (a ``_reason``) become kind ``X`` with a key of their
    own (their row number), so they ride the same shuffle as singleton groups,
    whatever their position says, and the input is read once for both pairs
    and quarantine. Only they carry their text; usable events carry frames.
    """
    ok = F.col("_reason").isNull()
    own_key = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    for name, value in (("_slice", F.lit(0)), ("_tie", F.lit(0)), ("_carried", F.lit(False))):
        if name not in events.columns:
            events = events.withColumn(name, value)
    return (events.select(*_EVENT, "_reason", F.when(~ok, F.col("value")).alias("value"), "_slice", "_tie", "_carried")
            .withColumn("_key", F.when(ok, F.col("event_id")).otherwise(own_key))
            .withColumn("window_start", _window_start(window))
            .withColumn("t", F.when(~ok, F.lit("X"))
                        .when((F.col("kind") == "S") & F.col("resp_id").isNull(), F.lit("N"))
                        .otherwise(F.col("kind"))))


def pair_events(events: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """J1 on classified events (``kind`` R/S, ``resp_id``) -> pairs.

    Returns one row per emitted pair: ``event_id, window_start, req, resp``
    where ``req`` / ``resp`` are structs of the envelope fields.
    """
    return _pair(_segmented(_keyed_events(events, window)))


def _part():
    return Window.partitionBy("_key", "window_start", "_slice").orderBy(F.desc("_carried"), "timestamp", "partition", "offset", "_tie")


def _segmented(ev: DataFrame) -> DataFrame:
    """Segments: a null-id response right after a response restarts the group."""
    part = _part()
    running = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = ev.withColumn("_prev_t", F.lag("t").over(part))
    return ev.withColumn("seg", F.sum(((F.col("t") == "N") & (F.col("_prev_t") == "S")).cast("int"))
                         .over(running))


def _pair(ev: DataFrame) -> DataFrame:
    part = _part()
    running = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Refused envelopes (X) are singleton groups: they pass every step below
    # untouched and leave as ``_rej`` rows of the same output.
    rs = ev.where(F.col("t").isin("R", "S", "X"))

    payload = F.struct(*[F.col(c) for c in _EVENT if c not in ("event_id",)])
    rs = (rs.withColumn("_ev", payload)
            .withColumn("_prev", F.lag(F.struct(F.col("t").alias("t"), F.col("seg").alias("seg"),
                                                F.col("_ev").alias("ev"))).over(part))
            .withColumn("rn", F.row_number().over(part)))
    seg_first = F.col("_prev").isNull() | (F.col("_prev.seg") != F.col("seg"))
    run_start = seg_first | (F.col("_prev.t") != F.col("t"))
    runs = rs.withColumn("seg_first", seg_first).where(run_start | (F.col("t") == "X"))

    # Run lengths, heads and the parity rule, on run starts only.
    nxt_rn, nxt_seg = F.lead("rn").over(part), F.lead("seg").over(part)
    runs = runs.withColumn("run_len", F.when(nxt_seg == F.col("seg"), nxt_rn - F.col("rn")))
    runs = runs.withColumn("run_idx", F.row_number().over(part))
    head = F.col("seg_first") | F.col("run_len").isNull() | (F.col("run_len") != 1)
    runs = runs.withColumn("head_idx", F.max(F.when(head, F.col("run_idx"))).over(running))
    runs = runs.withColumn("emit_b", F.col("run_len").isNotNull()
                           & (((F.col("run_idx") - F.col("head_idx")) % 2) == 0))
    # The closer is the first event of the next run; its partner the event before it.
    closers = runs.withColumn("_emit", F.lag("emit_b").over(part)).where(
        (F.col("_emit") & ~F.col("seg_first")) | (F.col("t") == "X"))
    req = F.when(F.col("t") == "R", F.col("_ev")).when(F.col("t") != "X", F.col("_prev.ev"))
    resp = F.when(F.col("t") == "S", F.col("_ev")).when(F.col("t") != "X", F.col("_prev.ev"))
    rej = F.when(F.col("t") == "X", F.struct(
        F.col("_reason").alias("reason"), "topic", "partition", "offset", "timestamp", "event_id", "value"))
    return closers.select("event_id", "window_start", req.alias("req"), resp.alias("resp"),
                          rej.alias("_rej"))


def pairs_to_inferences(pairs: DataFrame) -> DataFrame:
    """P8 after pairing: only the response sets ``id``, ``model_name``,
    ``model_version`` and ``occurred_at``. Bodies were parsed before the
    pairing; later refusals are located by the response's position."""
    rejected = F.col("_rej").isNotNull()
    src = F.struct(
        *[F.when(rejected, F.col(f"_rej.{c}")).otherwise(F.col(f"resp.{c}")).alias(c)
          for c in ("topic", "partition", "offset", "timestamp")],
        F.when(rejected, F.col("_rej.event_id")).otherwise(F.col("event_id")).alias("event_id"),
        F.col("_rej.value").alias("value"))
    return barrier(pairs.select(
        F.col("resp.resp_id").alias("id"),
        F.col("resp.model_name").alias("model_name"),
        F.col("resp.model_version").alias("model_version"),
        F.coalesce("resp.occurred_at", "_rej.timestamp").alias("occurred_at"),
        F.col("req.frame").alias("inputs"), F.col("resp.frame").alias("outputs"),
        F.col("_rej.reason").alias("_reason"), src.alias("_src")))


def kserve_inferences(envelopes: DataFrame, window: str = DEFAULT_WINDOW,
                      with_rejects: bool = True, hot_rows: int | None = HOT_ROWS,
                      model_name: str | None = None, model_version: str | None = None) -> DataFrame:
    """Envelopes -> completed inferences.

    Refused envelopes come along as rows with a ``_reason`` (Q1) unless
    ``with_rejects`` is False. A key with more than ``hot_rows`` messages in a
    window is folded in slices; to find such keys, headers and times are counted
    first (None: not looked for). Of ``model_name`` and ``model_version`` only the keys
    that have such a response are paired; the filter on inferences (F5 / F6) is still to
    be applied.
    """
    start = _window_start(window)
    keys = wanted_keys(envelopes, start, model_name, model_version) if model_name is not None or model_version is not None else None
    if hot_rows is not None:
        envelopes = sliced(envelopes, start, hot_rows)
    classified = classify(envelopes)
    if keys is not None:
        classified = keep_wanted(classified, keys, start)
    if not with_rejects:
        return pairs_to_inferences(pair_events(where(classified, F.col("_reason").isNull()), window))
    # One scan, one exchange: refused envelopes travel as singleton groups
    # through the pairing and come out as rows with their reason.
    return pairs_to_inferences(pair_events(classified, window))
