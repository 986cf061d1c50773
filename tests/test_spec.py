"""M2: logger specs from dicts and YAML; unknown keys refused."""

import pytest

from predlake.plans.spec import LoggerSpec, SpecError
from predlake.sinks import parquet as parquet_sink

YAML = """
apiVersion: v1alpha1
kind: InferenceLogger
metadata: {name: parcels}
spec:
  topic: depot
  events: {type: kserve, config: {window: 30 seconds}}
  schema: {type: avro, config: {columnNames: {inputs: [weight, postcode], outputs: [zone]}}}
  filters: {modelName: router, modelVersion: "7"}
  destination: {type: parquet, config: {url: "hdfs:///lake"}}
---
apiVersion: v1alpha1
kind: InferenceLogger
metadata: {name: letters}
spec:
  topic: depot
  events: {type: json}
  destination: {type: parquet, config: {url: /tmp/letters}}
"""


def test_yaml_of_two_loggers():
    parcels, letters = LoggerSpec.from_yaml(YAML)
    assert (parcels.name, parcels.topic, letters.name, letters.topic) == ("parcels", "depot", "letters", "depot")
    assert parcels.events.config == {"window": "30 seconds"} and parcels.filters == {"modelName": "router", "modelVersion": "7"}
    assert parcels.column_names() == {"inputs": ["weight", "postcode"], "outputs": ["zone"]}
    assert letters.schema is None and letters.column_names() == {"inputs": None, "outputs": None}


@pytest.mark.parametrize("part", ["events", "schema", "destination"])
def test_streams_refuse_unknown_types(part):
    from predlake.streaming.logger import check_types
    base = {"name": "x", "topic": "t", "events": {"type": "kserve"}, "schema": {"type": "avro"},
            "destination": {"type": "parquet", "config": {"url": "/x"}}}
    check_types(LoggerSpec.from_dict(base))
    with pytest.raises(SpecError):
        check_types(LoggerSpec.from_dict({**base, part: {"type": "no-such-type"}}))


def test_unknown_keys_refused():
    base = {"name": "x", "topic": "t", "events": {"type": "kserve"}, "destination": {"type": "parquet"}}
    LoggerSpec.from_dict(base)
    with pytest.raises(SpecError):
        LoggerSpec.from_dict({**base, "extra": 1})
    with pytest.raises(SpecError):
        LoggerSpec.from_dict({**base, "filters": {"model": "m"}})
    with pytest.raises(SpecError):
        LoggerSpec.from_dict({k: v for k, v in base.items() if k != "events"})


def test_destination_format_checked():
    with pytest.raises(ValueError):
        parquet_sink._check({"url": "/tmp/x", "format": "hdf5"})
    url, opts = parquet_sink._check({"url": "/tmp/x/", "options": {"compression": "zstd"}})
    assert url == "/tmp/x" and opts["compression"] == "zstd"


def test_batch_logger_writes_rows_and_quarantine(spark, tmp_path):
    from predlake.plans import feeds
    from predlake.plans.logger import run_logger, write_logger
    spec = LoggerSpec.from_dict({
        "name": "events-json", "topic": "t", "events": {"type": "json"},
        "filters": {"modelName": "click"},
        "destination": {"type": "parquet", "config": {"url": str(tmp_path / "lake")}}})
    env = feeds.json_events(spark, "/root/testdata/sf0.001")
    logged = run_logger(spec, env)
    path = write_logger(spec, logged, quarantine_url=str(tmp_path / "quarantine"))
    rows = spark.read.parquet(path)
    want = feeds.table(spark, "/root/testdata/sf0.001", "events").where("event_type = 'click'").count()
    assert rows.count() == want and rows.columns == ["id", "occurred_at", "user_id", "k", "value"]
