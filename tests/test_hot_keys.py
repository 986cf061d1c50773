"""Slices of hot keys: the transducer's maps, their composition, and the whole fold against the plain state machine."""

import datetime as dt
import statistics

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import T0, envelopes_df
from predlake.operators import hot_keys
from predlake.operators.correlate import _window_start, kserve_inferences
from predlake.plans import feeds
from test_fold import message, model

SF = "/root/testdata/sf0.01"


def step(state, kind):
    if kind == "N":
        return "" if state == "S" else state
    return kind if state in ("", kind) else ""


def facts(kinds):
    """What slice_maps finds out about a slice, by its definition."""
    real, seg, prev = [], 0, None
    for k in kinds:
        seg += k == "N" and prev == "S"
        if k != "N":
            real.append((k, seg))
        prev = k
    anchors = [i + 1 for i in range(1, len(real)) if real[i][1] != real[i - 1][1] or real[i][0] == real[i - 1][0]]
    return {"events": len(real), "anchor": max(anchors, default=None), "first": real[0][0] if real else None,
            "last": real[-1][0] if real else None, "starts_null": kinds[0] == "N", "cleared": bool(real) and seg > real[-1][1]}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("RSN"), min_size=1, max_size=14), st.sampled_from(["", "R", "S"]))
def test_a_slice_maps_states_like_its_events_one_by_one(kinds, start):
    want = start
    for k in kinds:
        want = step(want, k)
    assert hot_keys.end_state(start, **facts(kinds)) == want


@pytest.mark.parametrize("seed,rows", [(1, 7), (2, 25), (3, 60)])
def test_sliced_fold_equals_the_state_machine(spark, seed, rows):
    import random
    rng = random.Random(seed)
    log = [(f"k{rng.choice([0, 0, 0, 1, 2])}", rng.choice("RRSSNBT"), rng.choice([0, 1, 2, 3, 9_000, 12_000]) + rng.randrange(40), i) for i in range(300)]
    env = envelopes_df(spark, [message(k, kind, i, T0 + dt.timedelta(milliseconds=ms)) for k, kind, ms, i in log])
    assert hot_keys.find_hot_keys(env, _window_start("10 seconds"), rows) is not None
    inf = kserve_inferences(env, hot_rows=rows).select("_reason", "_src.event_id", "_src.offset", F.expr("to_json(inputs.rows)").alias("x")).collect()
    got = {(r.event_id, int(r.x.strip("[]")), r.offset) for r in inf if r._reason is None}
    assert got == {(k, r, s) for k, _, r, s in model([(k, kind, ms, i) for k, kind, ms, i in log])}
    assert sum(r._reason is None for r in inf) == len(got)
    # every refused message comes out once
    assert sorted(r.offset for r in inf if r._reason) == sorted(i for _, kind, _, i in log if kind in "BT")


def test_slices_are_even_and_cold_keys_are_left_alone(spark):
    env = feeds.hot_pairs(spark, SF)
    out = hot_keys.sliced(env, _window_start("3650 days"), 500)
    sizes = [r.n for r in out.where("not _carried").groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == env.count() and len(sizes) > 20
    assert max(sizes) <= 2 * statistics.median(sizes)
    carried = out.where("_carried").groupBy("_slice").count().collect()
    assert carried and all(r["count"] <= 3 for r in carried)      # one event for each key of a slice
    assert {r._slice for r in hot_keys.sliced(env, _window_start("3650 days"), 10 ** 9).select("_slice").distinct().collect()} == {0}


def test_equal_places_do_not_make_a_slice_larger(spark):
    rows = [message("a", "RS"[i % 2], 5, T0) for i in range(400)]
    out = hot_keys.sliced(envelopes_df(spark, rows), _window_start("10 seconds"), 50)
    assert max(r["count"] for r in out.groupBy("_slice").count().collect()) <= 110


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "BROADCAST_KEYS", 1)
    log = [(f"k{i % 4}", "RS"[(i // 4) % 2], i, i) for i in range(160)]
    env = envelopes_df(spark, [message(k, kind, i, T0 + dt.timedelta(milliseconds=ms)) for k, kind, ms, i in log])
    inf = kserve_inferences(env, hot_rows=10)
    assert inf.where("_reason is null").count() == len(model(log))
