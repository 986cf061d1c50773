"""Stream = batch on the same messages; stop and restart on a checkpoint (no loss, no repeats)."""

from predlake.operators.correlate import kserve_inferences
from predlake.plans import feeds
from predlake.plans.logger import datapoints
from predlake.plans.spec import LoggerSpec
from predlake.sinks.parquet import BATCH
from predlake.sources.envelopes import deliver_slice, read_envelopes, stage_slices, stream_envelopes
from predlake.streaming.logger import pin_schema, run_loggers, scratch

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "occurred_at", "X0", "X1", "Y0").collect())


def test_stream_equals_batch_and_restart(spark):
    base = scratch(spark, "test-stream")
    stage_slices(feeds.repeated_pairs(spark, SF), f"{base}/staged", 4)
    want = _rows(datapoints(kserve_inferences(read_envelopes(spark, f"{base}/staged"))).good)
    assert len(want) > 100
    spec = LoggerSpec.from_dict({"name": "s", "topic": "t", "events": {"type": "kserve", "config": {}},
                                 "destination": {"type": "parquet", "config": {"url": f"{base}/lake"}}})
    schema = pin_schema(spark, spec, f"{base}/staged")

    def run(*slices):
        for i in slices:
            deliver_slice(spark, f"{base}/staged", i, f"{base}/landing")
        run_loggers([spec], stream_envelopes(spark, f"{base}/landing"), {"s": schema}, f"{base}/ckpt", 2).awaitTermination()
        return _rows(spark.read.parquet(f"{base}/lake/s").drop(BATCH))

    first = run(0, 1)
    assert 0 < len(first) < len(want)
    assert run(2, 3) == want                # restart: nothing lost, nothing twice
    assert run() == want                    # rerun on the same checkpoint: no new rows


def test_loggers_of_one_stream_share_the_parse_of_their_schemas(spark, tmp_path, monkeypatch):
    from predlake.plans import feeds
    from predlake.plans.logger import EVENT_PROCESSORS
    from predlake.plans.spec import LoggerSpec
    from predlake.streaming.logger import pin_schema, pin_schemas
    feeds.kserve_pairs(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/landed")
    specs = [LoggerSpec.from_dict({"name": n, "topic": "t", "events": {"type": "kserve"}, "filters": {"modelName": n}, "destination": {"type": "parquet", "config": {"url": "/x"}}})
             for n in ("view", "click")]
    alone = {s.name: pin_schema(spark, s, f"{tmp_path}/landed") for s in specs}
    parsed, kserve = [], EVENT_PROCESSORS["kserve"]
    monkeypatch.setitem(EVENT_PROCESSORS, "kserve", lambda *a: parsed.append(1) or kserve(*a))
    assert pin_schemas(spark, specs, f"{tmp_path}/landed") == alone and len(parsed) == 1


def test_refused_messages_are_not_paired_for_a_schema(spark, tmp_path, monkeypatch):
    from predlake.operators import correlate
    from predlake.plans.logger import SCHEMA_PROVIDERS
    feeds.refused_pairs(spark, SF).write.parquet(f"{tmp_path}/landed")
    raw = {"name": "s", "topic": "t", "events": {"type": "kserve"}, "destination": {"type": "parquet", "config": {"url": "/x"}}}
    want = datapoints(kserve_inferences(read_envelopes(spark, f"{tmp_path}/landed"))).schema
    seen, pair = [], correlate.pair_events
    monkeypatch.setattr(correlate, "pair_events", lambda ev, *a: seen.append(ev.where("_reason IS NOT NULL").count()) or pair(ev, *a))
    assert pin_schema(spark, LoggerSpec.from_dict(raw), f"{tmp_path}/landed") == want and seen == [0]
    # a user's provider still gets them
    monkeypatch.setitem(SCHEMA_PROVIDERS, "own", lambda named, *a: seen.append(named.where("_reason IS NOT NULL").count()))
    pin_schema(spark, LoggerSpec.from_dict(raw | {"schema": {"type": "own"}}), f"{tmp_path}/landed")
    assert all(seen[1:]) and len(seen) == 3


def test_a_table_in_one_row_group_is_spread_over_all_cores(spark, tmp_path):
    from pyspark.sql import functions as F
    from predlake.plans import feeds
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    df = feeds.table(spark, str(tmp_path), "events")
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= spark.sparkContext.defaultParallelism


def test_a_batch_that_is_read_once_is_not_kept(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame
    from predlake.model import ENVELOPE
    body = F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('","inputs":[{"x":1}],"outputs":[{"y":0.5}],"occurred_at":"2024-01-01T00:00:00Z"}'))
    made = {"value": body, "offset": F.col("id"), "timestamp": F.timestamp_seconds("id")}
    spec = LoggerSpec.from_dict({"name": "s", "topic": "t", "events": {"type": "json"}, "destination": {"type": "parquet", "config": {"url": f"{tmp_path}/lake"}}})
    keeps, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: keeps.append(1) or persist(df, *a))

    def run(lo, hi, **more):
        spark.range(lo, hi).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENVELOPE]).write.mode("append").parquet(f"{tmp_path}/landing")
        keeps.clear()
        run_loggers([spec], stream_envelopes(spark, f"{tmp_path}/landing"), None, f"{tmp_path}/ckpt", 2, catalog=f"{tmp_path}/catalog", **more).awaitTermination()
        return len(keeps), sorted(int(r.id.split("_")[0]) for r in spark.read.parquet(f"{tmp_path}/lake/s").collect())
    assert run(0, 5) == (1, list(range(5)))            # its schema is inferred, then it is written
    assert run(5, 9) == (0, list(range(9)))            # the schema is registered: written as it is parsed
    assert run(9, 12, quarantine_url=f"{tmp_path}/q") == (1, list(range(12)))
