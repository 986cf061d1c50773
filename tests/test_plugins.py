"""The user's processors, many loggers by rules, model filters before the exchange, the topic sink's messages."""

import datetime as dt
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import T0, envelope, envelopes_df
from predlake.operators import routing
from predlake.operators.correlate import kserve_inferences
from predlake.operators.filters import filter_models
from predlake.operators.json_events import parse_json_events
from predlake.operators.user_arrow import arrow_inferences
from predlake.plans import feeds
from predlake.plans.logger import DESTINATIONS, destination, run_logger, schema_provider, write_logger
from predlake.operators.schema import PinnedSchema
from predlake.plans.spec import LoggerSpec
from predlake.sinks.kafka import to_messages

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SF = "/root/testdata/sf0.001"


def numbers(batch):
    values = [int(v) for v in batch.column("value").to_pylist()]
    return pa.RecordBatch.from_pydict({
        "id": [str(v) if v else None for v in values], "model_name": ["m"] * len(values), "model_version": [None] * len(values),
        "occurred_at": pa.nulls(len(values), pa.timestamp("us", "UTC")),
        "inputs": pa.array([[{"a": v}, {"a": None}] if v != 7 else None for v in values], pa.list_(pa.struct([("a", pa.int64())]))),
        "outputs": pa.array([[{"b": str(v)}] * 2 for v in values], pa.list_(pa.struct([("b", pa.string())])))})


def test_a_processor_on_arrow_batches_refuses_only_the_messages_that_raise(spark):
    env = envelopes_df(spark, [(None, v, [], "t", 0, i, T0) for i, v in enumerate(["1", "two", None, "0", "7", "5"])]).coalesce(1)
    inf = arrow_inferences(env, numbers, "array<struct<a: bigint>>", "array<struct<b: string>>")
    got = {r.offset: (r._reason or "").split(":")[0] for r in inf.select("_src.offset", "_reason").collect()}
    assert got == {0: "", 1: "processor_error", 2: "processor_error", 3: "missing_id", 4: "missing_inputs", 5: ""}
    assert any("invalid literal" in (r._reason or "") for r in inf.collect())
    spec = LoggerSpec.from_dict({"name": "n", "topic": "t", "events": {"type": "json"}, "destination": {"type": "parquet", "config": {"url": "/x"}}})
    logged = run_logger(spec, env, inferences=inf)
    assert sorted((r.id, r.a, r.b) for r in logged.good.collect()) == [("1_0", 1, "1"), ("1_1", None, "1"), ("5_0", 5, "5"), ("5_1", None, "5")]
    assert logged.quarantine.count() == 4
    with pytest.raises(TypeError):
        arrow_inferences(env, numbers, "array<bigint>", "array<struct<b: string>>")


def test_a_processor_that_loses_rows_is_refused(spark):
    env = envelopes_df(spark, [(None, "1", [], "t", 0, i, T0) for i in range(3)]).coalesce(1)
    inf = arrow_inferences(env, lambda b: numbers(b).slice(1), "array<struct<a: bigint>>", "array<struct<b: string>>")
    assert all(r._reason.startswith("processor_error") for r in inf.collect())


def test_own_schema_provider_and_destination(spark):
    seen = []

    @schema_provider("fixed-for-test")
    def provider(named, config, subject, catalog):
        return PinnedSchema([("user_id", "string"), ("k", "double")], [("value", "string")])

    @destination("list-for-test")
    def keep(rows, config, name):
        seen.append((name, config["label"], rows.dtypes[2:], rows.count()))
    try:
        spec = LoggerSpec.from_dict({"name": "own", "topic": "t", "events": {"type": "json"}, "schema": {"type": "fixed-for-test"},
                                     "destination": {"type": "list-for-test", "config": {"label": "L"}}})
        write_logger(spec, run_logger(spec, feeds.json_events(spark, SF)))
    finally:
        DESTINATIONS.pop("list-for-test")
    assert seen == [("own", "L", [("user_id", "string"), ("k", "double"), ("value", "string")], 1000)]


RULES = [("all", None, None, None, None), ("m", "m", None, ["p"], None), ("v2", None, "2", None, ["q"]), ("both", "m", "2", ["p", "q"], None), ("m", "m", None, ["p"], None)]


@pytest.mark.parametrize("bound", [routing.BROADCAST_RULES, 2])
def test_routing_by_rules(spark, monkeypatch, bound):
    monkeypatch.setattr(routing, "BROADCAST_RULES", bound)
    bodies = ['{"id":"a","model_name":"m","model_version":"1","inputs":[[1]],"outputs":[[0.5]]}', '{"id":"b","model_name":"m","model_version":"2","inputs":[[2]],"outputs":[[1.5]]}',
              '{"id":"c","inputs":[[3]],"outputs":[[2.5]]}', "{"]
    inf = parse_json_events(envelopes_df(spark, [(None, b, [], "t", 0, i, T0) for i, b in enumerate(bodies)]))
    routed = routing.route(inf, spark.createDataFrame(RULES, routing.RULE_DDL))
    got = sorted((r.logger, r.id, r.data, r._reason) for r in routed.collect())
    assert got == [("all", "a_0", '{"X0":1,"Y0":0.5}', None), ("all", "b_0", '{"X0":2,"Y0":1.5}', None), ("all", "c_0", '{"X0":3,"Y0":2.5}', None),
                   ("both", "b_0", None, "column_count_mismatch"),
                   ("m", "a_0", '{"Y0":0.5,"p":1}', None), ("m", "a_0", '{"Y0":0.5,"p":1}', None), ("m", "b_0", '{"Y0":1.5,"p":2}', None), ("m", "b_0", '{"Y0":1.5,"p":2}', None),
                   ("v2", "b_0", '{"X0":2,"q":1.5}', None)]
    types = {r.logger: r.columns for r in routing.routed_schemas(routed).collect()}
    assert set(types) == {"all", "m", "v2"} and types["v2"].startswith("OBJECT<X0: BIGINT, q: DECIMAL")


def test_rules_are_one_scan_one_join_one_write(spark):
    rules = spark.createDataFrame([(f"l{i}", f"m{i % 7}", None, None, None) for i in range(300)], routing.RULE_DDL)
    plan = routing.route(parse_json_events(feeds.json_events(spark, SF)), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in plan


def test_model_filter_leaves_keys_out_before_the_exchange(spark):
    env = feeds.kserve_pairs(spark, SF)
    want = sorted(tuple(r) for r in filter_models(kserve_inferences(env), "click", "v1").select("id", "occurred_at").collect())
    early = kserve_inferences(env, model_name="click", model_version="v1")
    assert sorted(tuple(r) for r in filter_models(early, "click", "v1").select("id", "occurred_at").collect()) == want
    # other models are gone before they are paired (a key or two may share a bit), refused messages are not
    kinds = {r.model_name: r["count"] for r in early.groupBy("model_name").count().collect()}
    assert kinds["click"] >= len(want) and sum(n for m, n in kinds.items() if m != "click") <= 3
    broken = kserve_inferences(feeds.broken_pairs(spark, SF), model_name="none of them")
    refused = kserve_inferences(feeds.broken_pairs(spark, SF)).where("_reason is not null").groupBy("_reason").count()
    assert sorted(map(tuple, broken.where("_reason is not null").groupBy("_reason").count().collect())) == sorted(map(tuple, refused.collect()))
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(_key") < plan.index("BroadcastHashJoin")   # the tree is printed from the top


def test_a_request_key_with_two_models_stays_whole(spark):
    def resp(model, ms, off):
        return envelope("a", "S", {"id": "a", "model_name": model, "predictions": [off]}, T0 + dt.timedelta(milliseconds=ms), off, ce_time="2024-01-01T00:00:00Z")

    def req(ms, off):
        return envelope("a", "R", {"instances": [[off]]}, T0 + dt.timedelta(milliseconds=ms), off)
    env = envelopes_df(spark, [req(0, 0), resp("x", 1, 1), resp("y", 2, 2), req(3, 3), resp("y", 4, 4)])
    got = filter_models(kserve_inferences(env, model_name="y"), "y").select(F.expr("to_json(inputs.rows)").alias("i"), "_src.offset").collect()
    assert [(r.i, r.offset) for r in got] == [("[[3]]", 2)]


def test_topic_messages_and_missing_connector(spark):
    msgs = to_messages(spark.createDataFrame([("a_0", "t", 1, None)], "id string, occurred_at string, `x y` bigint, z string")).collect()
    assert [(m.key, m.value) for m in msgs] == [("a_0", '{"id":"a_0","occurred_at":"t","x y":1}')]
    with pytest.raises(RuntimeError, match="connector"):
        DESTINATIONS["kafka"](spark.range(1).select(F.col("id").cast("string").alias("id")), {"bootstrapServers": "none"}, "l")


def test_a_batch_with_few_bad_rows_is_taken_in_parts(spark):
    """A batch of n rows with one that raises takes about 2 log n calls, not n, and comes out as one batch in order."""
    from pyspark.sql import types as T
    from predlake.model import ENVELOPE
    from predlake.operators.user_arrow import HEAD, LOCATOR, _guarded
    schema = T.StructType([*T.DataType.fromDDL(HEAD).fields, *T.DataType.fromDDL("inputs array<struct<a: bigint>>, outputs array<struct<b: string>>").fields,
                           *[ENVELOPE[c] for c in LOCATOR], *T.DataType.fromDDL("value string, _error string").fields])
    calls = []

    def counted(batch):
        calls.append(batch.num_rows)
        return numbers(batch)
    n, bad = 1000, {17, 900, 999}
    batch = pa.RecordBatch.from_pydict({"topic": ["t"] * n, "partition": pa.array([0] * n, pa.int32()), "offset": list(range(n)),
                                        "timestamp": pa.array([T0] * n, pa.timestamp("us", "UTC")), "value": ["x" if i in bad else str(i) for i in range(n)]})
    out = list(_guarded(counted, schema)([batch]))
    assert len(out) == 1 and out[0].column("offset").to_pylist() == list(range(n))
    assert {i for i, e in enumerate(out[0].column("_error").to_pylist()) if e} == bad
    assert out[0].column("id").to_pylist() == [None if i in bad or i == 0 else str(i) for i in range(n)]
    assert len(calls) < 100


def test_rules_with_one_key_and_names_share_the_typed_rows(spark):
    """An inference is typed once for the loggers that want the same of it: the exchange is before they are told apart."""
    inf = parse_json_events(envelopes_df(spark, [(None, '{"id":"%d","model_name":"m","inputs":[[1],[2]],"outputs":[[3],[4]]}' % i, [], "t", 0, i, T0) for i in range(20)]))
    rules = spark.createDataFrame([(f"l{i}", "m" if i % 2 else None, None, ["p"] if i % 3 else None, None) for i in range(100)] + [(None, "m", None, None, None)], routing.RULE_DDL)
    index = routing.rule_index(rules, 16).collect()
    assert len(index) == 4 and sum(r._slots for r in index) <= 16 + len(index) and sum(len(r._loggers) for r in index) == 101
    plain, gathered = routing.route(inf, rules), routing.route(inf, rules, gathered=True)
    rows = sorted(map(str, plain.select("logger", "id", "data").collect()))
    assert len(rows) == 101 * 40 and rows == sorted(map(str, gathered.select("logger", "id", "data").collect()))
    plan = gathered._jdf.queryExecution().executedPlan().toString()
    assert plan.index("explode(_loggers") < plan.index("Exchange")   # printed from the result down to the source
