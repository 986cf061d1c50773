"""Streams: windows stay open until they expire, late and refused rows come out, what is pending can be read."""

import datetime as dt

import pytest

from helpers import T0, envelope, envelopes_df
from predlake.plans.spec import LoggerSpec
from predlake.sources.envelopes import stream_envelopes
from predlake.streaming.correlate import pending_messages
from predlake.streaming.logger import run_loggers, scratch

OK = "2024-01-01T00:00:00Z"


def req(i, seconds, offset, partition=0):
    return envelope(f"e{i}", "R", {"instances": [[i]]}, T0 + dt.timedelta(seconds=seconds), offset, partition)


def resp(i, seconds, offset, partition=0):
    return envelope(f"e{i}", "S", {"id": f"e{i}", "predictions": [i]}, T0 + dt.timedelta(seconds=seconds), offset, partition, ce_time=OK)


@pytest.fixture
def stream(spark):
    base = scratch(spark, "open-windows")
    spec = LoggerSpec.from_dict({"name": "s", "topic": "t", "events": {"type": "kserve", "config": {}},
                                 "destination": {"type": "parquet", "config": {"url": f"{base}/lake"}}})

    def run(*rows):
        envelopes_df(spark, list(rows)).write.mode("append").parquet(f"{base}/landing")
        run_loggers([spec], stream_envelopes(spark, f"{base}/landing"), None, f"{base}/ckpt", 2, quarantine_url=f"{base}/q",
                    catalog=f"{base}/catalog").awaitTermination()

    def read(folder):
        try:
            return spark.read.parquet(f"{base}/{folder}").collect()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
    return run, read, base


def test_a_pair_behind_the_newest_message_is_logged_while_its_window_is_open(spark, stream):
    run, read, base = stream
    run(req(0, 23, 0))
    run(req(1, 11, 1), resp(1, 12, 2))
    assert [r.id for r in read("lake/s")] == ["e1_0"]
    assert [(r.event_id, r.kind, r.offset) for r in pending_messages(spark, f"{base}/ckpt").collect()] == [("e0", "R", 0)]
    run(req(2, 40, 3))                       # window [20, 30) lives until 40
    assert [(r.event_id, r.reason) for r in read("q/expired")] == [("e0", "window_expired")]
    run(resp(0, 24, 4))                      # too late now: out as a row of its own
    assert sorted((r.event_id, r.offset, r.value is not None) for r in read("q/expired")) == [("e0", 0, True), ("e0", 4, True)]
    assert [r.event_id for r in pending_messages(spark, f"{base}/ckpt").collect()] == ["e2"]
    assert [r.id for r in read("lake/s")] == ["e1_0"]


def test_null_times_and_positions_do_not_stop_a_stream(spark, stream):
    run, read, base = stream
    late = envelope("e5", "R", {"instances": [[5]]}, None, 9)
    run(late, req(1, 1, None, None), resp(1, 1, 3), req(1, 1, 2))
    run(req(2, 2, None), resp(2, 2, None))
    assert sorted(r.id for r in read("lake/s")) == ["e1_0", "e2_0"]
    assert [(r.reason, r.offset) for r in read("q/messages")] == [("missing_timestamp", 9)]


def test_batch_refuses_what_has_no_time(spark):
    from predlake.operators.correlate import kserve_inferences
    inf = kserve_inferences(envelopes_df(spark, [envelope("a", "R", {"instances": [[1]]}, None, 0), req(1, 1, 1), resp(1, 2, 2)])).collect()
    assert sorted(str(r._reason) for r in inf) == ["None", "missing_timestamp"]


def test_a_stream_without_a_usable_message_pins_nothing_and_a_restart_reuses_the_pin(spark, stream):
    from predlake.operators.schema import lookup
    run, read, base = stream
    run(envelope("x", "R", "{", T0, 0))
    assert lookup(spark, f"{base}/catalog", "s-value") is None and [r.reason for r in read("q/messages")] == ["malformed_body"]
    run(req(1, 1, 1), resp(1, 2, 2))
    first = lookup(spark, f"{base}/catalog", "s-value")
    assert first.inputs == [("X0", "bigint")] and first.version == 1
    run(envelope("e3", "R", {"instances": [["text"]]}, T0 + dt.timedelta(seconds=3), 3), resp(3, 4, 4))
    assert lookup(spark, f"{base}/catalog", "s-value") == first
    assert [r.reason for r in read("q/s")] == ["type_mismatch"] and [r.id for r in read("lake/s")] == ["e1_0"]


def test_sources_by_spec_and_bounded_micro_batches(spark):
    from predlake.plans.spec import SpecError
    from predlake.streaming.logger import source_of
    base = scratch(spark, "source")
    rows = [(None, '{"id":"%d","inputs":[{"a":%d}],"outputs":[{"b":1}]}' % (i, i), [], "t", 0, i, T0) for i in range(12)]
    envelopes_df(spark, rows).repartition(4).write.parquet(f"{base}/landing")

    def spec(**config):
        return LoggerSpec.from_dict({"name": "s", "topic": "t", "events": {"type": "json", "config": config},
                                     "destination": {"type": "parquet", "config": {"url": f"{base}/lake"}}})
    one = spec(path=f"{base}/landing", maxFilesPerTrigger=1)
    query = run_loggers([one], source_of(spark, one), None, f"{base}/ckpt", catalog=f"{base}/catalog")
    query.awaitTermination()
    lake = spark.read.parquet(f"{base}/lake/s")
    assert sorted(r.a for r in lake.collect()) == list(range(12)) and lake.select("logger_batch").distinct().count() == 4
    with pytest.raises(RuntimeError, match="connector"):
        source_of(spark, spec(bootstrapServers="broker:9092", options={"maxOffsetsPerTrigger": 10}))
    with pytest.raises(SpecError):
        source_of(spark, spec())
    with pytest.raises(SpecError):
        run_loggers([one, spec(path="/elsewhere")], source_of(spark, one), None, f"{base}/ckpt2")
