"""J1 as a stream: ST1 / ST2 / W1 / W2 / W3 / X1 with ``transformWithState``.

Messages are classified once. The grouping is by a hash bucket of ``ce_id`` and a
time bucket (X1: its shuffle is the repartition by key); what is pending is one entry of
a ``MapState`` for each (ce_id, window) (ST1), in the RocksDB state store under the
query checkpoint (ST2). A micro-batch folds its messages in (timestamp, partition,
offset) order, nulls first, reads and writes the entries of its own keys only, emits a
pair the moment both sides are pending and the response has an ``id``, and removes the
entry.

Spark hands a Python processor its rows cell by cell, and a nested row costs more than its
fold. So a message goes to the processor as one JSON text and comes out in it as it went in, many to a
row; the JVM writes and reads the texts. The state keeps the texts, and its calls
are sent many at a time (:mod:`predlake.streaming.entries`).

A window lives until its end plus ``expires`` of event time (W2), wherever its messages
stand beside the newest one. The clock is the newest message time; it is a
column of its own that is dropped before the grouping, so Spark keeps the watermark
but drops no rows by it. The processor decides: a message of an expired window, and one
that is still unpaired when its window expires, leaves as a row with the reason
``window_expired`` (W3, Q1). The clock after a micro-batch is no earlier than the newest message of a
group, so what is unpaired in a window that has expired by that message leaves at once and
never enters the state: a replay's micro-batch spans many windows. Refused messages pass through with their reason and
never touch the state. So every delivered message is in a pair, pending, refused,
expired, or was replaced by a repeat (A1).
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from predlake.model import DEFAULT_EXPIRY, DEFAULT_WINDOW, FRAME_DDL
from predlake.functions.barrier import barrier
from predlake.operators.envelope import classify
from predlake.streaming.entries import Entries

EVENT_DDL = ("kind string, resp_id string, event_time string, value string, topic string, "
             "partition int, offset bigint, timestamp timestamp")
PAIR_DDL = (f"event_id string, window_start timestamp, req struct<{EVENT_DDL}>, resp struct<{EVENT_DDL}>, "
            f"reason string, refused struct<{EVENT_DDL}>")
ENTRY_KEY_DDL = "event_id string, window_start bigint"   # micros
ENTRY_DDL = "req string, resp string"                     # texts (_TEXT_DDL)
STATE = "pending"
EXPIRED = "window_expired"
BUCKETS_PER_PARTITION = 4   # default hash buckets of ce_id per state partition and time bucket
TIME_BUCKET = "1 day"      # default time bucket of a grouping key (a multiple of the window)
_FIELDS = [f.split(" ")[0] for f in EVENT_DDL.split(", ")]
_PLACE = [_FIELDS.index(f) for f in ("timestamp", "partition", "offset")]
_TIME = _PLACE[0]
_EVENT_ROW, _PAIR_ROW = Row(*_FIELDS), Row("event_id", "window_start", "req", "resp", "reason", "refused")

# A message as text: times are micros; "reason" is there where it is refused.
_TEXT_DDL = f"event_id string, window_start bigint, {EVENT_DDL.replace('timestamp timestamp', 'timestamp bigint')}"
_OUT_DDL = f"req struct<{_TEXT_DDL}>, resp struct<{_TEXT_DDL}>, reason string, refused struct<{_TEXT_DDL}>"
PACKED_DDL = "packed array<string>"
PACKED_ROWS = 500           # texts in one row that the processor gives back
_PACKED_ROW = Row("packed")

# The processor runs in Python workers that need not have this package on
# their path: ship this module's code with the pickled processor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _interval_ms(text: str) -> int:
    n, unit = text.split()
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(float(n) * scale[unit.rstrip("s")])


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _micros(time: dt.datetime) -> int:
    return (time.astimezone(dt.timezone.utc) - _EPOCH) // dt.timedelta(microseconds=1)


def _place(event: tuple) -> list:
    """Sort key of an event; a null position comes first."""
    return [(event[i] is not None, event[i]) if event[i] is not None else (False,) for i in _PLACE]


class PairProcessor(StatefulProcessor):
    """Emit-and-clear fold of requests and responses per (ce_id, window); expiry by window end.

    Its rows have the fields of EVENT_DDL, event_id, window_start and reason; it gives rows of PAIR_DDL.
    """

    def __init__(self, window_ms: int, expiry_ms: int):
        self.window_ms = window_ms
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState(STATE, ENTRY_KEY_DDL, ENTRY_DDL)
        self.entries = Entries(self.pending)

    # --- how messages come and leave ---------------------------------------------

    def _messages(self, rows) -> Iterator[tuple]:
        """(event_id, window start in micros, reason, event) of each row."""
        for x in rows:
            yield x["event_id"], _micros(x["window_start"]), x["reason"], tuple(x[f] for f in _FIELDS)

    def _time(self, e) -> int:
        """The time of an event in ms."""
        return _micros(e[_TIME]) // 1000

    def _stored(self, e):
        """An event as the state keeps it."""
        return e

    def _loaded(self, kept) -> tuple | None:
        return kept

    def _out(self, event_id, start, req=None, resp=None, reason=None, refused=None):
        """``refused`` may be as the state keeps it."""
        def event(e):
            return None if e is None else _EVENT_ROW(*e)
        return _PAIR_ROW(event_id, start, event(req), event(resp), reason, event(refused))

    def _gathered(self, out: Iterator) -> Iterator:
        return out

    # --- the fold ---------------------------------------------------------------

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._gathered(self._fold(rows, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._gathered(self._expire(max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())))

    def _expires(self, start: int) -> int:
        """Event time (ms) from which on a window takes no more messages."""
        return start // 1000 + self.window_ms + self.expiry_ms

    def _fold(self, rows, now: int) -> Iterator:
        came: dict[tuple, list] = {}
        for event_id, start, reason, e in self._messages(rows):
            if reason is None and self._expires(start) <= now:
                reason = EXPIRED
            if reason is not None:
                yield self._out(event_id, start, reason=reason, refused=e)
            else:
                came.setdefault((event_id, start), []).append(e)
        stored = self.entries.get(came) if came and self.pending.exists() else {}
        put, gone, ends = [], [], []
        clock = max(now, max((self._time(e) for events in came.values() for e in events), default=now))   # after this batch, at the least
        for entry, events in came.items():
            req, resp = map(self._loaded, stored.get(entry, (None, None)))
            if len(events) > 1:
                events.sort(key=_place)
            for e in events:
                if e[0] == "R":
                    req = e
                else:
                    resp = e
                if req is not None and resp is not None and resp[1] is not None:
                    yield self._out(*entry, req, resp)
                    req = resp = None
            waits = req is not None or resp is not None
            if waits and self._expires(entry[1]) <= clock:
                for e in (req, resp):
                    if e is not None:
                        yield self._out(*entry, reason=EXPIRED, refused=e)
                waits = False
            if waits:
                put.append((entry, (self._stored(req), self._stored(resp))))
                ends.append(entry[1])
            elif entry in stored:
                gone.append(entry)
        self.entries.put(put)
        self.entries.remove(gone)
        if ends:   # one timer for a group: it clears what has expired by then and sets the next one
            self.handle.registerTimer(self._expires(min(ends)))

    def _expire(self, now: int) -> Iterator:
        """What is still pending of the windows that have expired leaves, request before response."""
        gone, left = [], []
        for entry, slot in self.entries.all():
            if self._expires(entry[1]) > now:
                left.append(entry[1])
                continue
            gone.append(entry)
            for e in slot:
                if e is not None:
                    yield self._out(*entry, reason=EXPIRED, refused=e)
        self.entries.remove(gone, all_of_them=not left)
        if left:
            self.handle.registerTimer(self._expires(min(left)))

    def close(self) -> None:
        pass


class PackedPairProcessor(PairProcessor):
    """The same fold on messages that are texts: its rows have ``message`` (_TEXT_DDL and reason), it gives PACKED_DDL (_OUT_DDL each)."""

    def _messages(self, rows) -> Iterator[tuple]:
        for x in rows:
            m = json.loads(x["message"])
            yield m.get("event_id"), m.get("window_start"), m.get("reason"), self._event(m, x["message"])

    def _time(self, e) -> int:
        return e[_TIME] // 1000

    def _event(self, m: dict, text: str) -> tuple:
        return (*map(m.get, _FIELDS), text)

    def _stored(self, e) -> str | None:
        return None if e is None else e[-1]

    def _loaded(self, kept: str | None) -> tuple | None:
        return None if kept is None else self._event(json.loads(kept), kept)

    def _out(self, event_id, start, req=None, resp=None, reason=None, refused=None) -> str:
        if reason is None:
            return f'{{"req":{req[-1]},"resp":{resp[-1]}}}'
        return f'{{"reason":{json.dumps(reason)},"refused":{refused if isinstance(refused, str) else refused[-1]}}}'

    def _gathered(self, out: Iterator[str]) -> Iterator[Row]:
        texts = []
        for text in out:
            texts.append(text)
            if len(texts) == PACKED_ROWS:
                yield _PACKED_ROW(texts)
                texts = []
        if texts:
            yield _PACKED_ROW(texts)


def window_start(ts: str, window: str) -> F.Column:
    """Tumbling window start as plain arithmetic (a second event-time column
    derived with ``window()`` would clash with the watermarked one)."""
    ms = _interval_ms(window)
    return F.timestamp_millis(F.floor(F.unix_millis(F.col(ts)) / ms) * ms)


def stream_pairs(envelopes: DataFrame, window: str = DEFAULT_WINDOW,
                 expiry: str = DEFAULT_EXPIRY, id_buckets: int | None = None,
                 time_bucket: str = TIME_BUCKET) -> DataFrame:
    """Envelopes of a stream (or batch) -> emitted pairs, refused and expired messages (``PAIR_DDL``).

    A grouping key is a hash bucket of ``ce_id`` and a time bucket; one call folds
    the messages of a key in one micro-batch, which the source's rate bounds.
    ``id_buckets`` and ``time_bucket`` are settings of the logger (``stateBuckets``,
    ``stateTime``), fixed for the life of a checkpoint; by default the buckets grow
    with the state partitions. A message without a time is refused before.
    """
    id_buckets = id_buckets or BUCKETS_PER_PARTITION * int(envelopes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if envelopes.isStreaming:
        clock = F.coalesce(F.col("timestamp"), F.timestamp_millis(F.lit(0)))
        envelopes = envelopes.withColumn("_clock", clock).withWatermark("_clock", "0 seconds").drop("_clock")
    time_mode = "EventTime" if envelopes.isStreaming else "None"
    ev = classify(envelopes).select("event_id", *_FIELDS, F.col("_reason").alias("reason"))
    ev = ev.withColumn("window_start", window_start("timestamp", window))
    bucket_ms = _interval_ms(time_bucket)
    times = [F.unix_micros(c).alias(c) for c in ("window_start", "timestamp")]
    message = F.to_json(F.struct("event_id", times[0], *[f for f in _FIELDS if f != "timestamp"], times[1], "reason"))
    id_bucket = F.pmod(F.xxhash64("event_id", F.when(F.col("reason").isNotNull(), F.col("offset"))), F.lit(id_buckets))
    bucket = F.coalesce(F.floor(F.unix_millis("window_start") / bucket_ms), F.lit(0))
    ev = ev.select((bucket * id_buckets + id_bucket).alias("_group"), message.alias("message"))   # one column: each costs a Python worker time
    packed = (ev.groupBy("_group")
              .transformWithState(PackedPairProcessor(_interval_ms(window), _interval_ms(expiry)), PACKED_DDL, "Append", time_mode))
    out = barrier(packed.select(F.explode("packed").alias("_text")).select(F.from_json("_text", _OUT_DDL).alias("_out")))

    def event(name):
        fields = [F.timestamp_micros(f"_out.{name}.{f}").alias(f) if f == "timestamp" else F.col(f"_out.{name}.{f}").alias(f) for f in _FIELDS]
        return F.when(F.col(f"_out.{name}").isNotNull(), F.struct(*fields)).alias(name)
    return out.select(F.coalesce("_out.req.event_id", "_out.refused.event_id").alias("event_id"),
                      F.timestamp_micros(F.coalesce("_out.req.window_start", "_out.refused.window_start")).alias("window_start"),
                      event("req"), event("resp"), F.col("_out.reason").alias("reason"), event("refused"))


def stream_inferences(pairs: DataFrame) -> DataFrame:
    """Pairs of a stream -> inferences; refused and expired messages come along with their ``_reason`` (Q1).

    State values are plain text, so the two bodies of a pair are parsed once more.
    """
    from predlake.functions.frames import parse_body, request_frame_sql, response_frame_sql
    from predlake.functions.times import parse_iso
    paired = F.col("reason").isNull()
    df = (pairs.withColumn("_rq", F.when(paired, F.expr(parse_body("req.value")))).withColumn("_rs", F.when(paired, F.expr(parse_body("resp.value"))))
          .withColumn("inputs", F.when(paired, F.expr(request_frame_sql("_rq", "req.value"))))
          .withColumn("outputs", F.when(paired, F.expr(response_frame_sql("_rs", "resp.value")))))
    src = F.struct(*[F.when(paired, F.col(f"resp.{c}")).otherwise(F.col(f"refused.{c}")).alias(c) for c in ("topic", "partition", "offset", "timestamp")],
                   "event_id", F.col("refused.value").alias("value"))
    return barrier(df.select(
        F.col("resp.resp_id").alias("id"), F.col("_rs.model_name").alias("model_name"),
        F.col("_rs.model_version").alias("model_version"),
        F.when(paired, parse_iso("resp.event_time")).otherwise(F.col("refused.timestamp")).alias("occurred_at"),
        F.col("inputs").cast(FRAME_DDL).alias("inputs"), F.col("outputs").cast(FRAME_DDL).alias("outputs"), F.col("reason").alias("_reason"), src.alias("_src")))


def pending_messages(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """ST1 / ST2: the messages that wait for their other side, read from the state of a stream's checkpoint.

    One row for each message: event_id, window_start, kind, resp_id, topic, partition, offset, timestamp.
    ``batch_id`` reads the state after an earlier micro-batch.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    entries = reader.load().select(F.col("user_map_key.event_id").alias("event_id"), F.timestamp_micros("user_map_key.window_start").alias("window_start"),
                                   F.explode(F.array_compact(F.array("user_map_value.req", "user_map_value.resp"))).alias("_text"))
    entries = entries.withColumn("e", F.from_json("_text", _TEXT_DDL))
    return entries.select("event_id", "window_start", *[F.col(f"e.{c}").alias(c) for c in ("kind", "resp_id", "topic", "partition", "offset")],
                          F.timestamp_micros("e.timestamp").alias("timestamp"))
