"""The streaming fold (PairProcessor) against the plain-Python model, without Spark:
random logs, delivered in time order over several micro-batches."""

import datetime as dt

from hypothesis import given, settings, strategies as st

from predlake.streaming.correlate import PairProcessor, _FIELDS
from test_fold import model

T0 = dt.datetime(2024, 1, 1)
WINDOW_MS = 10_000


class _Map:
    def __init__(self):
        self.v, self.touched = {}, 0

    def exists(self):
        return bool(self.v)

    def getValue(self, k):
        self.touched += 1
        return self.v.get(k)

    def updateValue(self, k, v):
        self.touched += 1
        self.v[k] = v

    def removeKey(self, k):
        self.touched += 1
        self.v.pop(k, None)

    def iterator(self):
        return iter(list(self.v.items()))


class _Handle:
    def __init__(self):
        self.maps, self.timers = {}, set()

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, _Map())

    def registerTimer(self, ms):
        self.timers.add(ms)


class _Info:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms


class _Timers:
    def __init__(self, wm):
        self.wm = wm

    def getCurrentWatermarkInMs(self):
        return self.wm


event = st.tuples(st.integers(0, 4), st.sampled_from("RSN"), st.integers(0, 60_000))
EPOCH = int(T0.timestamp() * 1000)


def _input(key, kind, ms, off, reason=None, partition=0):
    return {"event_id": f"k{key}", "window_start": T0 + dt.timedelta(milliseconds=ms // WINDOW_MS * WINDOW_MS), "kind": "R" if kind == "R" else "S",
            "resp_id": "x" if kind == "S" else None, "event_time": None, "value": None, "topic": "t", "partition": partition,
            "offset": off, "timestamp": T0 + dt.timedelta(milliseconds=ms), "reason": reason, "_ms": ms}


def _run(batches, expiry=WINDOW_MS):
    """The processor over micro-batches like Spark: one for each grouping key, timers after the input; all rows out."""
    procs, out, wm = {}, [], 0
    for batch in [*batches, []]:
        groups = {}
        for r in batch:
            groups.setdefault(hash(r["event_id"]) % 3, []).append({f: r[f] for f in ["event_id", "window_start", "reason"] + _FIELDS})
        for k, rows in groups.items():
            if k not in procs:
                procs[k] = PairProcessor(WINDOW_MS, expiry)
                procs[k].init(_Handle())
            out += procs[k].handleInputRows(k, iter(rows), _Timers(wm))
        for p in procs.values():
            for ms in sorted(t for t in p.handle.timers if t <= wm):
                p.handle.timers.discard(ms)
                out += p.handleExpiredTimer(None, _Timers(wm), _Info(ms))
        wm = max([wm, *(r["_ms"] + EPOCH for r in batch)])
    return out, [e for p in procs.values() for e in p.pending.v.items()]


@settings(max_examples=60, deadline=None)
@given(st.lists(event, min_size=1, max_size=80), st.integers(1, 6))
def test_processor_matches_model(log, n_batches):
    rows = sorted((_input(key, kind, ms, off) for off, (key, kind, ms) in enumerate(log)), key=lambda r: (r["timestamp"], r["offset"]))
    size = -(-len(rows) // n_batches)
    out, _ = _run([rows[b:b + size] for b in range(0, len(rows), size)])
    got = {(r.event_id, r.req.offset, r.resp.offset) for r in out if r.reason is None}
    assert got == {(k, r, s) for k, _, r, s in model([(f"k{key}", kind, ms, off) for off, (key, kind, ms) in enumerate(log)])}


@settings(max_examples=60, deadline=None)
@given(st.permutations(range(24)), st.integers(1, 8))
def test_every_message_is_accounted_for(order, n_batches):
    """One request and response for each of 12 ids, in any order of delivery: paired, pending or expired, by window end."""
    log = [_input(i, kind, 4_000 * i + (0 if kind == "R" else 7_000 * (i % 2)), 2 * i + (kind == "S")) for i in range(12) for kind in "RS"]
    log = [log[i] for i in order]
    size = -(-len(log) // n_batches)
    batches = [log[b:b + size] for b in range(0, len(log), size)]
    out, pending = _run(batches)
    paired = [o for r in out if r.reason is None for o in (r.req.offset, r.resp.offset)]
    expired = [r.refused.offset for r in out if r.reason == "window_expired"]
    waiting = [e[list(e).index("t") + 2] for _, slot in pending for e in slot if e]
    assert sorted(paired + expired + waiting) == list(range(24))
    # a message is late only if the newest message of earlier batches lies its window's end and the expiry behind
    wm, late = 0, set()
    for b in batches:
        late |= {r["offset"] for r in b if EPOCH + r["_ms"] // WINDOW_MS * WINDOW_MS + 2 * WINDOW_MS <= wm}
        wm = max([wm, *(r["_ms"] + EPOCH for r in b)])
    assert late <= set(expired)
    by_id = {o: (o // 2, next(r["_ms"] for r in log if r["offset"] == o) // WINDOW_MS) for o in range(24)}
    for i in range(12):
        if not {2 * i, 2 * i + 1} & late and by_id[2 * i] == by_id[2 * i + 1]:
            assert {2 * i, 2 * i + 1} <= set(paired)


def test_a_row_behind_the_newest_pairs_while_its_window_is_open():
    out, _ = _run([[_input(0, "R", 23_000, 0)], [_input(1, "R", 11_000, 1), _input(1, "S", 12_000, 2)]])
    assert [(r.req.offset, r.resp.offset) for r in out if r.reason is None] == [(1, 2)]


def test_refused_rows_pass_and_null_positions_sort_first():
    rows = [_input(0, "R", 5, None, partition=None), _input(0, "R", 5, 7), _input(0, "S", 6, None, partition=None), _input(0, "R", 5, 3, reason="malformed_body")]
    out, pending = _run([rows])
    assert [(r.reason, r.refused.offset) for r in out if r.reason] == [("malformed_body", 3)]
    assert [(r.req.offset, r.resp.offset) for r in out if r.reason is None] == [(7, None)] and not pending


def test_a_batch_touches_its_own_entries_only():
    p = PairProcessor(WINDOW_MS, WINDOW_MS)
    p.init(_Handle())
    list(p.handleInputRows(0, iter([_input(i, "R", i, i) for i in range(500)]), _Timers(0)))
    p.pending.touched = 0
    assert len(list(p.handleInputRows(0, iter([_input(3, "S", 600, 900)]), _Timers(0)))) == 1
    assert p.pending.touched == 2 and len(p.pending.v) == 499


# --- the processor as it runs in Spark: messages are texts, the state's calls go many at a time ---------------

class _Api:
    """The client's end of the state server: answers are there once a flush has sent their requests."""

    def __init__(self):
        from pyspark.serializers import CPickleSerializer
        self.pickleSer, self.sockfile, self.sent, self.asked, self.flushes = CPickleSerializer(), self, b"", [], []

    def write(self, data):
        self.sent += data

    def flush(self):
        import pyspark.sql.streaming.proto.StateMessage_pb2 as proto
        size, n = len(self.sent), 0
        while self.sent:
            length = int.from_bytes(self.sent[4:8], "big")
            request = proto.StateRequest.FromString(self.sent[8:8 + length])
            self.asked.append(request.stateVariableRequest.mapStateCall)
            self.sent, n = self.sent[8 + length:], n + 1
        self.flushes.append((n, size))

    def _receive_proto_message(self):
        call, self.store = self.asked.pop(0), self.__dict__.get("store", {})
        if call.HasField("updateValue"):
            self.store[call.updateValue.userKey] = call.updateValue.value
        elif call.HasField("removeKey"):
            self.store.pop(call.removeKey.userKey, None)
        return 0, "", self.store.get(call.getValue.userKey, b"") if call.HasField("getValue") else b""

    def _deserialize_from_bytes(self, data):
        return self.pickleSer.loads(data)


class _Client:
    def __init__(self):
        self._stateful_processor_api_client = _Api()


class _State:
    """A MapState of Spark's client."""
    _stateName = "pending"

    def __init__(self):
        self._mapStateClient = _Client()
        self.api = self._mapStateClient._stateful_processor_api_client

    def _store(self):
        return self.api.__dict__.get("store", {})

    def exists(self):
        return bool(self._store())

    def iterator(self):
        return iter([(self.api._deserialize_from_bytes(k), self.api._deserialize_from_bytes(v)) for k, v in self._store().items()])

    def clear(self):
        self._store().clear()


def test_calls_of_the_state_go_many_at_a_time():
    from predlake.streaming.entries import MOST_BYTES, MOST_CALLS, Entries
    state = _State()
    entries, keys = Entries(state), [(f"k{i}", i) for i in range(1000)]
    entries.put([(k, (f"text {k[0]}", None)) for k in keys])
    assert len(state.api.flushes) <= 10 and state.exists()
    assert entries.get(keys[:3] + [("none", 1)]) == {k: (f"text {k[0]}", None) for k in keys[:3]}
    entries.remove(keys[:400])
    assert sorted(k for k, _ in entries.all()) == sorted(keys[400:]) and len(state.api.flushes) < 20
    entries.put([(("long", i), ("x" * 20_000, None)) for i in range(3)] + [(("longer", 0), ("x" * 100_000, None))])
    assert all(n <= MOST_CALLS and (n == 1 or size <= MOST_BYTES + 8 * n) for n, size in state.api.flushes)
    entries.remove([], all_of_them=True)
    assert not state.exists()


def _packed(batches, expiry=WINDOW_MS):
    """Texts out of the packed processor on one group, and what is pending; timers after each batch."""
    import json
    from predlake.streaming.correlate import PackedPairProcessor
    p, handle, wm, out = PackedPairProcessor(WINDOW_MS, expiry), _Handle(), 0, []
    handle.getMapState = lambda *a: _State()
    p.init(handle)

    def text(r):
        us = {f: (r[f] - T0) // dt.timedelta(microseconds=1) + EPOCH * 1000 for f in ("window_start", "timestamp")}
        return json.dumps({f: v for f, v in (r | us).items() if f != "_ms" and v is not None})
    for batch in [*batches, []]:
        if batch:
            out += p.handleInputRows(0, iter([{"message": text(r)} for r in batch]), _Timers(wm))
        for ms in sorted(t for t in handle.timers if t <= wm):
            handle.timers.discard(ms)
            out += p.handleExpiredTimer(None, _Timers(wm), _Info(ms))
        wm = max([wm, *(r["_ms"] + EPOCH for r in batch)])
    return [json.loads(t) for row in out for t in row.packed], [json.loads(t) for _, slot in p.entries.all() for t in slot if t]


@settings(max_examples=60, deadline=None)
@given(st.lists(event, min_size=1, max_size=60), st.integers(1, 5), st.sampled_from([WINDOW_MS, 10 * WINDOW_MS]), st.booleans())
def test_packed_messages_fold_as_rows_do(log, n_batches, expiry, in_order):
    rows = [_input(key, kind, ms, off) for off, (key, kind, ms) in enumerate(log)]
    for r, (_, kind, _) in zip(rows, log):
        r["resp_id"] = None if kind == "N" else r["resp_id"]   # a null id never completes a pair
    rows = sorted(rows, key=lambda r: (r["timestamp"], r["offset"])) if in_order else rows
    size = -(-len(rows) // n_batches)
    batches = [rows[b:b + size] for b in range(0, len(rows), size)]
    out, pending = _run(batches, expiry)
    got, waits = _packed(batches, expiry)
    assert sorted((r["req"]["offset"], r["resp"]["offset"]) for r in got if "reason" not in r) == sorted((r.req.offset, r.resp.offset) for r in out if r.reason is None)
    assert sorted((r["reason"], r["refused"]["offset"]) for r in got if "reason" in r) == sorted((r.reason, r.refused.offset) for r in out if r.reason)
    assert sorted(m["offset"] for m in waits) == sorted(e[list(e).index("t") + 2] for _, slot in pending for e in slot if e)


def test_what_has_expired_by_the_end_of_its_batch_never_enters_the_state():
    p = PairProcessor(WINDOW_MS, WINDOW_MS)
    p.init(_Handle())
    rows = [_input(i, "R", 1000 * i, i) for i in range(60)] + [_input(7, "S", 7_500, 100), _input(8, "N", 8_500, 101)]
    out = list(p.handleInputRows(0, iter(rows), _Timers(EPOCH)))
    assert [(r.req.offset, r.resp.offset) for r in out if r.reason is None] == [(7, 100)]
    # the newest message is at 59 s: windows up to [30, 40) have expired
    assert sorted(r.refused.offset for r in out if r.reason == "window_expired") == [i for i in range(40) if i != 7] + [101]
    assert p.pending.touched == 20


def test_a_text_keeps_what_a_message_says():
    odd = _input(0, "R", 5, None, partition=None) | {"value": '{"a": "\u00e9\"\\ \n \U0001f600"}', "event_id": 'id "x"'}
    refused = _input(0, "S", 7, 3, reason="malformed_body") | {"value": None}
    out, pending = _packed([[odd, refused]])
    assert [(r["reason"], r["refused"].get("value"), r["refused"]["offset"]) for r in out] == [("malformed_body", None, 3)]
    assert [(m["event_id"], m["value"], m.get("offset")) for m in pending] == [('id "x"', odd["value"], None)]
