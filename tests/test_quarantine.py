"""Every refused envelope gets a reason; nothing is silently lost."""

import datetime as dt

from helpers import T0, envelope, envelopes_df
from predlake.operators import quarantine as Q
from predlake.operators.correlate import kserve_inferences

GOOD = "2024-01-01T00:00:00Z"


def test_equal_and_missing_positions_lose_no_row(spark):
    rows = [envelope("a", "R", "{", T0, 7) for _ in range(5)] + [envelope("b", "R", "{", T0, None, partition=None) for _ in range(4)]
    q = Q.to_quarantine(kserve_inferences(envelopes_df(spark, rows)))
    assert sorted((r.offset is None, r.value) for r in q.collect()) == [(False, "{")] * 5 + [(True, "{")] * 4


def test_reasons(spark):
    t = T0
    rows = [
        envelope(None, "R", {"instances": [[1]]}, t, 0),                       # F1
        envelope("", "R", {"instances": [[1]]}, t, 1),                         # F1 empty
        envelope("b", "S", None, t, 2),                                        # F2
        envelope("c", None, {"instances": [[1]]}, t, 3),                       # B2
        envelope("d", "org.example.other", {"instances": [[1]]}, t, 4),        # F3
        envelope("e", "R", '{"instances": [[', t, 5),                          # malformed
        envelope("f", "S", {"predictions": [1]}, t, 6),                        # F4
        envelope("g", "R", {"data": [1]}, t, 7),                               # P7
        envelope("h", "S", {"id": "h", "foo": 1}, t, 8),                       # P7
        envelope("i", "R", {"inputs": [{"name": "a", "shape": [1], "data": [1]},
                                       {"name": "b", "shape": [2], "data": [1, 2]}]}, t, 9),
        envelope("i", "S", {"id": "i", "predictions": [1]}, t + dt.timedelta(milliseconds=1), 10, ce_time=GOOD),
        envelope("j", "R", {"instances": [[1, 2]]}, t, 11),
        envelope("j", "S", {"id": "j", "predictions": [0.5]}, t + dt.timedelta(milliseconds=1), 12, ce_time=GOOD),
        envelope("k", "S", {"id": "k", "predictions": [1]}, t, 13),                          # P8, B2
        envelope("k", "S", {"id": "k", "predictions": [1]}, t, 14, ce_time="soon"),
        envelope("k", "S", {"id": "k", "predictions": [1]}, t, 15, ce_time="12:30:00"),      # D1: no date
        envelope("l", "R", '{"instances": [[1]]} xyz', t, 16),
        envelope("l", "R", '{"instances": [[1]]},{"instances": [[1]]}', t, 17),
        envelope("l", "R", '[{"instances": [[1]]}]', t, 18),
        envelope("l", "R", '{"instances": [[NaN]]}', t, 19),
        envelope("l", "R", {"inputs": [{"shape": [1], "data": [1]}]}, t, 20),                # P4: no name
    ]
    inf = kserve_inferences(envelopes_df(spark, rows))
    q = {(r.reason, r.offset) for r in Q.to_quarantine(inf).collect()}
    assert q == {("missing_event_id", 0), ("missing_event_id", 1), ("null_body", 2),
                 ("missing_event_type", 3), ("unknown_event_type", 4), ("malformed_body", 5),
                 ("response_without_id", 6), ("no_instances_or_inputs", 7),
                 ("no_predictions_or_outputs", 8), ("unequal_tensor_lengths", 9),
                 ("missing_event_time", 13), ("bad_event_time", 14), ("bad_event_time", 15),
                 *(("malformed_body", i) for i in range(16, 20)), ("bad_tensors", 20)}
    good = Q.good(inf).collect()
    assert [g.id for g in good] == ["j"]
