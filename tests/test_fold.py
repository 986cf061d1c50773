"""The window-function fold equals a plain-Python state machine.

Random logs with few keys, repeats of both kinds, null-id responses and
events spread over several 10 s windows (hypothesis).
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from helpers import T0, envelope, envelopes_df
from predlake.operators.correlate import kserve_inferences, pair_events
from predlake.operators.envelope import classify
from predlake.functions.barrier import where
from pyspark.sql import functions as F


def model(events):
    """events: (key, kind, ms, offset) with kind R, S, N (null id), B (refused body) or T (refused time).

    Refused ones change nothing. Returns {(key, window, req_off, resp_off)}."""
    groups = {}
    for key, kind, ms, off in events:
        if kind in "BT":
            continue
        groups.setdefault((key, ms // 10_000), []).append((ms, off, kind))
    out = set()
    for (key, w), evs in groups.items():
        r = s = None
        s_ok = False
        for ms, off, kind in sorted(evs):
            if kind == "R":
                r = off
            else:
                s, s_ok = off, kind == "S"
            if r is not None and s is not None and s_ok:
                out.add((key, w, r, s))
                r = s = None
    return out


event = st.tuples(st.integers(0, 5), st.sampled_from("RRSSNBT"), st.integers(0, 35_000))
UNEQUAL = {"inputs": [{"name": "p", "shape": [1], "data": [1]}, {"name": "q", "shape": [2], "data": [1, 2]}]}


def message(key, kind, off, ts):
    if kind in "RB":
        return envelope(key, "R", UNEQUAL if kind == "B" else {"instances": [[off]]}, ts, off)
    body = {"id": None if kind == "N" else key, "predictions": [off]}
    return envelope(key, "S", body, ts, off, ce_time="yesterday" if kind == "T" else "2024-01-01T00:00:00Z")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=120))
def test_fold_matches_state_machine(spark, log):
    rows, events = [], []
    for off, (key, kind, ms) in enumerate(log):
        ts = T0 + dt.timedelta(milliseconds=ms)
        rows.append(message(f"k{key}", kind, off, ts))
        events.append((f"k{key}", kind, ms, off))
    env = envelopes_df(spark, rows)
    pairs = pair_events(where(classify(env), F.col("_reason").isNull()))
    got = {(p.event_id, p.req.offset, p.resp.offset) for p in pairs.collect()}
    want = {(k, r, s) for k, _, r, s in model(events)}
    assert got == want


def test_fold_examples(spark):
    # R R S S R S R R R: pairs (R2,S3), (R5,S4), (R7,S6)
    seq = "RRSSRSRRR"
    rows = [message("a", k, i, T0 + dt.timedelta(milliseconds=i)) for i, k in enumerate(seq)]
    pairs = {(p.req.offset, p.resp.offset) for p in pair_events(
        where(classify(envelopes_df(spark, rows)), F.col("_reason").isNull())).collect()}
    assert pairs == {(1, 2), (4, 3), (6, 5)}


def test_window_boundary_never_pairs(spark):
    rows = [envelope("a", "R", {"instances": [[1]]}, T0 + dt.timedelta(seconds=9.999), 0),
            envelope("a", "S", {"id": "a", "predictions": [1]}, T0 + dt.timedelta(seconds=10.001), 1, ce_time="2024-01-01T00:00:10Z")]
    assert kserve_inferences(envelopes_df(spark, rows), with_rejects=False).count() == 0
