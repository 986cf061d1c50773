"""Envelope feeds derived from the test tables (TESTDATA) with Spark.

Each feed turns a base table into the messages a model server would publish,
so the registered queries exercise the parsers on data whose size grows with
the tables. Every feed is a narrow projection (plus one ``groupBy`` per order
for the multi-row payloads), never a driver-side loop.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from predlake.functions.times import format_iso
from predlake.model import REQUEST_TYPE, RESPONSE_TYPE

N_TOPIC_PARTITIONS = 8


TASKS_PER_CORE = 4


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A base table; wall-clock (NTZ) timestamps read as UTC instants.

    A file of few row groups is read by few tasks whatever its number of rows, and a feed's
    messages are built and parsed by the tasks that read them; so the narrow rows are spread over all
    cores first. Not where the feed shuffles the table by a key next anyway.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread:
        df = df.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    ntz = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    for c in ntz:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def two_envelopes(df: DataFrame, request: list[Column], response: list[Column]) -> DataFrame:
    """A request and a response envelope per row of ``df``, from one scan.

    Every column is made after the rows are doubled, so a reader of some columns (the count of hot keys
    reads no bodies) has only these made.
    """
    names = df.select(*request).columns
    return (df.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("_is_request"))
            .select(*[F.when(F.col("_is_request"), a).otherwise(b).alias(n) for n, a, b in zip(names, request, response)]))


def _headers(event_id: Column, event_type: Column | None = None,
             event_time: Column | None = None) -> Column:
    hs = [F.struct(F.lit("ce_id").alias("key"), event_id.cast("binary").alias("value"))]
    if event_type is not None:
        hs.append(F.struct(F.lit("ce_type").alias("key"), event_type.cast("binary").alias("value")))
    if event_time is not None:
        hs.append(F.struct(F.lit("ce_time").alias("key"), event_time.cast("binary").alias("value")))
    return F.array(*hs)


def envelope(value: Column, key: Column, headers: Column, ts: Column, offset: Column,
             topic: str = "inferences") -> list[Column]:
    """Columns of one envelope; partition = hash of the key, like a producer."""
    return [
        key.cast("string").cast("binary").alias("key"),
        value.alias("value"),
        headers.alias("headers"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(key.cast("string")), F.lit(N_TOPIC_PARTITIONS)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        ts.alias("timestamp"),
    ]


# --- JSON events --------------------------------------------------------------

def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> one JSON inference event per row.

    id = event_id, model = event_type, inputs ``[{user_id, k}]`` with ``k``
    from ``props``, outputs ``[{value}]``, occurred_at = ts as ISO text.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(*_json_envelope(_json_body()))


def _json_body() -> Column:
    return F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("model_name"),
        F.lit("v1").alias("model_version"),
        F.array(F.struct(F.col("user_id").alias("user_id"),
                         F.get_json_object("props", "$.k").cast("bigint").alias("k"))).alias("inputs"),
        F.array(F.struct(F.col("value").alias("value"))).alias("outputs"),
        format_iso("ts").alias("occurred_at"),
    ))


def _json_envelope(body: Column) -> list[Column]:
    return envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")), F.col("ts"), F.col("event_id"), topic="json-events")


def clashing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events with ``k`` as input column ``score`` and ``value`` as output column ``score``; view events have no such output."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    outputs = F.when(F.col("event_type") == "view", F.to_json(F.array(F.struct(F.lit(1).alias("rank"))))) \
               .otherwise(F.to_json(F.array(F.struct(F.lit(1).alias("rank"), F.col("value").alias("score")))))
    body = F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","inputs":'),
                    F.to_json(F.array(F.struct(k.alias("score"), F.col("user_id").alias("user_id")))), F.lit(',"outputs":'), outputs, F.lit("}"))
    return ev.select(*envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")), F.col("ts"), F.col("event_id"), topic="json-events"))


def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json_events`` with text after the object in click events, and error events cut short."""
    ev = table(spark, sf_dir, "events").withColumn("_body", _json_body())
    kind = F.col("event_type")
    return ev.select(*_json_envelope(F.when(kind == "click", F.concat("_body", F.lit(" <<end of line>>")))
                                     .when(kind == "error", F.expr("substring(_body, 1, length(_body) - 9)")).otherwise(F.col("_body"))))


# --- KServe request / response pairs ------------------------------------------

def response_delay_ms(event_id: Column) -> Column:
    """Deterministic response latency of the correlate feed (0 .. 11,999 ms)."""
    return (event_id * 7919) % 12000


def kserve_pairs(spark: SparkSession, sf_dir: str, topic: str = "kserve") -> DataFrame:
    """``events`` -> a V1 request at ``ts`` and its response at ``ts + delay``.

    Request ``{"instances": [[user_id, k]]}``; response ``{"id", "model_name",
    "model_version", "predictions": [value]}`` with ``ce_time`` = response time;
    the version is v2 where ``k`` is divisible by 3, else v1.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    ce_id = F.concat(F.lit("evt-"), F.col("event_id").cast("string"))
    resp_ts = F.col("ts") + F.make_dt_interval(secs=response_delay_ms(F.col("event_id")) / 1000.0)
    req_body = F.to_json(F.struct(F.array(F.array(F.col("user_id"), F.col("k"))).alias("instances")))
    resp_body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("model_name"),
        F.when(F.col("k") % 3 == 0, "v2").otherwise("v1").alias("model_version"),
        F.array(F.col("value")).alias("predictions")))
    return two_envelopes(
        ev, envelope(req_body, ce_id, _headers(ce_id, F.lit(REQUEST_TYPE)), F.col("ts"), F.col("event_id") * 2, topic),
        envelope(resp_body, ce_id, _headers(ce_id, F.lit(RESPONSE_TYPE), format_iso(resp_ts)), resp_ts,
                 F.col("event_id") * 2 + 1, topic))


def kserve_envelopes(df: DataFrame, ce_id: Column, ts: Column, req_body: Column,
                     resp_body: Column, offset: Column, topic: str = "kserve",
                     resp_ts: Column | None = None) -> DataFrame:
    """A request and a response envelope per row of ``df`` (same ``ce_id``)."""
    resp_ts = ts if resp_ts is None else resp_ts
    return two_envelopes(
        df, envelope(req_body, ce_id, _headers(ce_id, F.lit(REQUEST_TYPE)), ts, offset * 2, topic),
        envelope(resp_body, ce_id, _headers(ce_id, F.lit(RESPONSE_TYPE), format_iso(resp_ts)), resp_ts, offset * 2 + 1, topic))


# --- lineitem: multi-row payloads ---------------------------------------------

MESSAGE_ROWS = 16   # datapoints per message; an order's lines span several messages

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def order_messages(spark: SparkSession, sf_dir: str, size: int = MESSAGE_ROWS) -> DataFrame:
    """``lineitem`` -> one row per message: an order's lines in chunks of ``size``.

    Lines are numbered per order by (linenumber, partkey, suppkey,
    extendedprice); chunking bounds a message whatever the order's size, and
    the window and the grouping share one shuffle on ``l_orderkey``.
    """
    from pyspark.sql import Window
    li = table(spark, sf_dir, "lineitem", spread=False)
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    li = li.withColumn("_rn", F.row_number().over(w) - 1)
    li = li.withColumn("chunk", F.floor(F.col("_rn") / size)).withColumn("i", F.col("_rn") % size)
    g = li.groupBy("l_orderkey", "chunk").agg(
        F.sort_array(F.collect_list(F.struct(
            "i", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linenumber"))).alias("lines"),
        F.max("l_shipdate").alias("ts"),
        F.max("l_returnflag").alias("max_flag"))
    return g.withColumn("ce_id", F.concat(F.lit("o"), F.col("l_orderkey").cast("string"),
                                          F.lit("-"), F.col("chunk").cast("string")))


def _resp(id_col: Column, model: Column, **payload: Column) -> Column:
    return F.to_json(F.struct(id_col.alias("id"), model.alias("model_name"),
                              F.lit("v1").alias("model_version"),
                              *[v.alias(k) for k, v in payload.items()]))


def v1_orders(spark: SparkSession, sf_dir: str, truncate_flag: str | None = None) -> DataFrame:
    """V1: ``instances`` = [[quantity, extendedprice], ...], ``predictions`` = [discount, ...].

    With ``truncate_flag``, messages whose largest returnflag equals it lose
    their last prediction (J2 then truncates to the shorter side).
    """
    m = order_messages(spark, sf_dir)
    req = F.to_json(F.struct(F.expr("transform(lines, l -> array(l.l_quantity, l.l_extendedprice))")
                             .alias("instances")))
    preds = F.expr("transform(lines, l -> l.l_discount)")
    if truncate_flag is not None:
        preds = F.when(F.col("max_flag") == truncate_flag,
                       F.slice(preds, 1, F.size("lines") - 1)).otherwise(preds)
    resp = _resp(F.col("ce_id"), F.lit("lineitem-v1"), predictions=preds)
    return kserve_envelopes(m, F.col("ce_id"), F.col("ts"), req, resp,
                            F.xxhash64("l_orderkey", "chunk").bitwiseAND(F.lit((1 << 61) - 1)))


def _tensor(name: str, datatype: str, data: Column, shape: Column | None = None) -> Column:
    shape = F.array(F.size(data)) if shape is None else shape
    return F.struct(F.lit(name).alias("name"), shape.alias("shape"),
                    F.lit(datatype).alias("datatype"), data.alias("data"))


def _json_list(*items: Column) -> Column:
    """A JSON array of differently typed objects (an SQL array needs one type)."""
    return F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(i) for i in items]), F.lit("]"))


def v2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 named tensors: quantity FP64, returnflag BYTES, linenumber INT32 -> tax FP64."""
    m = order_messages(spark, sf_dir)
    ins = _json_list(
        _tensor("quantity", "FP64", F.expr("transform(lines, l -> l.l_quantity)")),
        _tensor("returnflag", "BYTES", F.expr("transform(lines, l -> l.l_returnflag)")),
        _tensor("linenumber", "INT32", F.expr("transform(lines, l -> l.l_linenumber)")))
    outs = F.array(_tensor("tax", "FP64", F.expr("transform(lines, l -> l.l_tax)")))
    req = F.concat(F.lit('{"inputs":'), ins, F.lit("}"))
    resp = _resp(F.col("ce_id"), F.lit("lineitem-v2"), outputs=outs)
    return kserve_envelopes(m, F.col("ce_id"), F.col("ts"), req, resp,
                            F.xxhash64("l_orderkey", "chunk").bitwiseAND(F.lit((1 << 61) - 1)))


# --- embeddings: matrix tensors -----------------------------------------------

EMBED_TS = "2024-01-01 00:00:00"


def _embed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return (e.withColumn("ce_id", F.concat(F.lit("vec-"), F.col("vec_id").cast("string")))
             .withColumn("ts", F.lit(EMBED_TS).cast("timestamp") + F.make_dt_interval(secs=F.col("vec_id")))
             # float32 -> double first, so the JSON text is the exact float value
             .withColumn("vec", F.expr("transform(embedding, x -> cast(x as double))")))


def v2_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``[1, 64]`` tensor per vector (P5) -> label ``[1]``."""
    e = _embed_base(spark, sf_dir)
    ins = F.array(_tensor("embedding", "FP32", F.array(F.col("vec")),
                          F.array(F.lit(1), F.size("vec"))))
    outs = F.array(_tensor("label", "INT32", F.array(F.col("label"))))
    return kserve_envelopes(e, F.col("ce_id"), F.col("ts"), F.to_json(F.struct(ins.alias("inputs"))),
                            _resp(F.col("ce_id"), F.lit("embedder"), outputs=outs), F.col("vec_id"))


def v2_text_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A BYTES ``[1]`` tensor next to a ``[1, 64]`` tensor (P4 list cells)."""
    e = _embed_base(spark, sf_dir)
    ins = _json_list(
        _tensor("text", "BYTES", F.array(F.col("ce_id"))),
        _tensor("embedding", "FP32", F.array(F.col("vec")), F.array(F.lit(1), F.size("vec"))))
    outs = F.array(_tensor("label", "INT32", F.array(F.col("label"))))
    return kserve_envelopes(e, F.col("ce_id"), F.col("ts"), F.concat(F.lit('{"inputs":'), ins, F.lit("}")),
                            _resp(F.col("ce_id"), F.lit("embedder"), outputs=outs), F.col("vec_id"))


# --- documents + labels: dict rows --------------------------------------------

def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events with dict rows whose keys differ and are out of order.

    inputs ``[{n_chars, lang}, {source, lang}]``; outputs from ``labels``
    (left join) ``[{quality, toxic}, {toxic}]`` -- unlabelled documents have
    empty dicts. No ``occurred_at``: the envelope time is used.
    """
    d = table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels", spread=False)
    j = d.join(lab, "doc_id", "left")
    head = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"),
                              F.lit("doc-quality").alias("model_name")))
    body = F.concat(
        F.substring_index(head, "}", 1),   # the head object without its closing brace
        F.lit(',"inputs":'), _json_list(F.struct("n_chars", "lang"), F.struct("source", "lang")),
        F.lit(',"outputs":'), _json_list(F.struct("quality", "toxic"), F.struct("toxic")),
        F.lit("}"))
    ts = F.lit(EMBED_TS).cast("timestamp") + F.make_dt_interval(secs=F.col("doc_id"))
    return j.select(*envelope(body, F.col("doc_id"), _headers(F.col("doc_id").cast("string")),
                              ts, F.col("doc_id"), topic="documents"))


# --- conversations: turns as request / response --------------------------------

def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn is a request, the assistant turn right after it its response.

    ``ce_id`` = conv-turn of the user turn; an assistant turn answers turn-1.
    Both sides of a conversation share one timestamp (one window).
    """
    c = table(spark, sf_dir, "conversations")
    is_user = F.col("role") == "user"
    ref_turn = F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1)
    ce_id = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), ref_turn.cast("string"))
    ts = F.lit(EMBED_TS).cast("timestamp") + F.make_dt_interval(mins=F.col("conv_id").cast("int"))
    req = F.to_json(F.struct(F.array(F.array(F.col("text"))).alias("instances")))
    resp = _resp(ce_id, F.lit("assistant"), predictions=F.array(F.col("text")))
    body = F.when(is_user, req).otherwise(resp)
    ctype = F.when(is_user, F.lit(REQUEST_TYPE)).otherwise(F.lit(RESPONSE_TYPE))
    c = c.where(F.col("role").isin("user", "assistant"))
    return c.select(*envelope(body, ce_id, _headers(ce_id, ctype, format_iso(ts)), ts,
                              F.col("conv_id") * 1024 + F.col("turn"), topic="conversations"))


# --- broken traffic: every quarantine reason --------------------------------------

BAD_UNKNOWN_TYPE = "org.example.unknown"


def broken_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``kserve_pairs`` feed with faults chosen by model (event_type) and ``k``:

    error -> request without ce_id; signup -> response with a null body;
    view -> response without "id"; click -> request with neither instances
    nor inputs; purchase with k >= 90 -> malformed request JSON; purchase
    with k < 10 -> response of an unknown CloudEvent type.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    et, k = F.col("event_type"), F.col("k")
    ce_id = F.concat(F.lit("evt-"), F.col("event_id").cast("string"))
    resp_ts = F.col("ts") + F.make_dt_interval(secs=response_delay_ms(F.col("event_id")) / 1000.0)
    good_req = F.to_json(F.struct(F.array(F.array(F.col("user_id"), k)).alias("instances")))
    req_body = (F.when(et == "click", F.to_json(F.struct(F.array(F.col("user_id")).alias("data"))))
                .when((et == "purchase") & (k >= 90), F.lit('{"instances": [['))
                .otherwise(good_req))
    resp_fields = [F.col("event_type").alias("model_name"), F.lit("v1").alias("model_version"),
                   F.array(F.col("value")).alias("predictions")]
    resp_body = (F.when(et == "signup", F.lit(None).cast("string"))
                 .when(et == "view", F.to_json(F.struct(*resp_fields)))
                 .otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), *resp_fields))))
    req_headers = F.when(et == "error", F.array(F.struct(F.lit("ce_type").alias("key"),
                                                          F.lit(REQUEST_TYPE).cast("binary").alias("value")))) \
                   .otherwise(_headers(ce_id, F.lit(REQUEST_TYPE)))
    resp_type = F.when((et == "purchase") & (k < 10), F.lit(BAD_UNKNOWN_TYPE)).otherwise(F.lit(RESPONSE_TYPE))
    return two_envelopes(
        ev, envelope(req_body, ce_id, req_headers, F.col("ts"), F.col("event_id") * 2, "kserve"),
        envelope(resp_body, ce_id, _headers(ce_id, resp_type, format_iso(resp_ts)), resp_ts, F.col("event_id") * 2 + 1, "kserve"))


# --- timestamps in several ISO-8601 forms ------------------------------------------

def iso_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events whose ``occurred_at`` uses a form chosen by event_type.

    click: extended with Z; view: local time with a +02:00 offset; signup:
    basic form (whole seconds); purchase: a date only; error: empty text.
    """
    ev = table(spark, sf_dir, "events")
    ts, et = F.col("ts"), F.col("event_type")
    txt = (F.when(et == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(et == "view", F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
           .when(et == "signup", F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))
           .when(et == "purchase", F.date_format(ts, "yyyy-MM-dd"))
           .otherwise(F.lit("")))
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), et.alias("model_name"),
        F.array(F.struct(F.col("event_id").alias("e"))).alias("inputs"),
        F.array(F.struct(F.col("value").alias("v"))).alias("outputs"),
        txt.alias("occurred_at")))
    return ev.select(*envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")),
                               ts, F.col("event_id"), topic="json-events"))


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as lines of text, ``event_id|event_type|user_id|k|value`` with null as nothing; error events lack their end."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (F.col("event_id"), F.col("event_type"), F.col("user_id"), k, F.col("value"))]
    line = F.concat_ws("|", *parts)
    body = F.when(F.col("event_type") == "error", F.substring_index(line, "|", 3)).otherwise(line)
    return ev.select(*envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")), F.col("ts"), F.col("event_id"), topic="lines"))


def mixed_type_events(spark: SparkSession, sf_dir: str, text: str = "error") -> DataFrame:
    """JSON events whose ``code`` is a number, except text ``"E<k>"`` for events of type ``text``."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    code = F.when(F.col("event_type") == text, F.concat(F.lit('"E'), k, F.lit('"'))).otherwise(k)
    body = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","model_name":"'), F.col("event_type"),
        F.lit('","inputs":[{"user_id":'), F.coalesce(F.col("user_id").cast("string"), F.lit("null")),
        F.lit(',"code":'), F.coalesce(code, F.lit("null")),
        F.lit('}],"outputs":[{"value":'), F.coalesce(F.col("value").cast("string"), F.lit("null")),
        F.lit("}]}"))
    return ev.select(*envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")),
                               F.col("ts"), F.col("event_id"), topic="json-events"))


def growing_events(spark: SparkSession, sf_dir: str, parts: int = 3) -> DataFrame:
    """JSON events whose payload grows over three parts of their time: ``code`` is ``k``; then ``k + 0.5`` with a
    new text column ``region``; then ``k`` again, but text for click events."""
    from predlake.sources.envelopes import time_slices
    ev = time_slices(table(spark, sf_dir, "events").withColumn("timestamp", F.col("ts")), parts)
    k = F.get_json_object("props", "$.k").cast("bigint")
    part = F.col("slice")
    code = (F.when(part == 1, (k + F.lit(0.5)).cast("string"))
            .when((part == 2) & (F.col("event_type") == "click"), F.concat(F.lit('"E'), k.cast("string"), F.lit('"'))).otherwise(k.cast("string")))
    region = F.when(part > 0, F.concat(F.lit(',"region":"'), F.col("event_type"), F.lit('"'))).otherwise(F.lit(""))
    body = F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","model_name":"'), F.col("event_type"), F.lit('","inputs":[{"user_id":'),
                    F.coalesce(F.col("user_id").cast("string"), F.lit("null")), F.lit(',"code":'), F.coalesce(code, F.lit("null")), region,
                    F.lit('}],"outputs":[{"value":'), F.coalesce(F.col("value").cast("string"), F.lit("null")), F.lit("}]}"))
    return ev.select(*envelope(body, F.col("event_id"), _headers(F.col("event_id").cast("string")), F.col("ts"), F.col("event_id"), topic="json-events"))


# --- repeats: re-sent requests and responses, null ids --------------------------------

def repeated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``kserve_pairs`` feed plus repeats chosen by model (event_type).

    Base: request R0 at ``ts`` ``[[user_id, k]]``; response S0 at
    ``rts = ts + delay`` ``[value]``. Extra per model: click -> R1 at ts+1ms
    with ``k + 1000``; view -> S1 at rts+2ms with ``value + 1``; signup -> a
    null-id response at ts-1ms; purchase -> a null-id response at
    ts + delay/2; error -> a null-id response at rts+3ms.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    et = F.col("event_type")
    delay = response_delay_ms(F.col("event_id"))
    rts = F.col("ts") + F.make_dt_interval(secs=delay / 1000.0)

    def ms(n):
        return F.make_dt_interval(secs=F.lit(n / 1000.0))

    def item(kind, ts, off, x1=None, y0=None, rid=True, when=None):
        s = F.struct(F.lit(kind).alias("kind"), ts.alias("ets"),
                     (F.col("event_id") * 10 + off).alias("off"),
                     (x1 if x1 is not None else F.col("k")).alias("x1"),
                     (y0 if y0 is not None else F.col("value")).alias("y0"),
                     F.lit(rid).alias("rid"))
        return s if when is None else F.when(when, s)
    items = F.array_compact(F.array(
        item("R", F.col("ts"), 0),
        item("S", rts, 1),
        item("R", F.col("ts") + ms(1), 2, x1=F.col("k") + 1000, when=et == "click"),
        item("S", rts + ms(2), 3, y0=F.col("value") + 1, when=et == "view"),
        item("S", F.col("ts") - ms(1), 4, y0=F.col("value") + 2, rid=False, when=et == "signup"),
        item("S", F.col("ts") + F.make_dt_interval(secs=F.floor(delay / 2) / 1000.0), 5,
             rid=False, when=et == "purchase"),
        item("S", rts + ms(3), 6, rid=False, when=et == "error")))
    x = ev.select("*", F.explode(items).alias("e"))
    ce_id = F.concat(F.lit("evt-"), F.col("event_id").cast("string"))
    req = F.to_json(F.struct(F.array(F.array(F.col("user_id"), F.col("e.x1"))).alias("instances")))
    resp = F.to_json(F.struct(
        F.when(F.col("e.rid"), F.col("event_id").cast("string")).alias("id"),
        et.alias("model_name"), F.array(F.col("e.y0")).alias("predictions")),
        {"ignoreNullFields": "false"})
    is_req = F.col("e.kind") == "R"
    headers = F.when(is_req, _headers(ce_id, F.lit(REQUEST_TYPE))) \
               .otherwise(_headers(ce_id, F.lit(RESPONSE_TYPE), format_iso(F.col("e.ets"))))
    return x.select(*envelope(F.when(is_req, req).otherwise(resp), ce_id, headers,
                              F.col("e.ets"), F.col("e.off"), "kserve"))


# --- hot keys: all traffic on three ids ------------------------------------------------

def hot_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages of three ids, told apart by ``event_id % 3``: nearly all of one kind of state change each.

    Every event is a request at ``ts``, or a response where ``user_id`` is odd (with a null id where
    ``k`` is divisible by 7); click events are sent again 3 ms later as the other kind. The
    message time is the event's, so ids are hot where the window is long.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    odd = F.coalesce(F.col("user_id") % 2, F.lit(0)) == 1
    x = ev.select("*", F.explode(F.when(F.col("event_type") == "click", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    is_req = F.when(F.col("again") == 0, ~odd).otherwise(odd)
    ts = F.col("ts") + F.make_dt_interval(secs=F.col("again") * F.lit(0.003))
    ce_id = F.concat(F.lit("hot-"), (F.col("event_id") % 3).cast("string"))
    req = F.to_json(F.struct(F.array(F.array("event_id")).alias("instances")))
    resp = F.to_json(F.struct(F.when(~F.coalesce(F.col("k") % 7 == 0, F.lit(False)), F.col("event_id").cast("string")).alias("id"),
                              F.array("event_id").alias("predictions")), {"ignoreNullFields": "false"})
    headers = F.when(is_req, _headers(ce_id, F.lit(REQUEST_TYPE))).otherwise(_headers(ce_id, F.lit(RESPONSE_TYPE), format_iso(ts)))
    return x.select(*envelope(F.when(is_req, req).otherwise(resp), ce_id, headers, ts, F.col("event_id") * 2 + F.col("again"), "kserve"))


# --- refused messages between good ones ------------------------------------------------

APPENDED = (', "x": 2', ', "body": {"instances": [[9]]}', ', "end of body": 1} garbage', ', {"instances": [[9]]}', ', 1], [2')


def refused_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of ``kserve_pairs`` without delay, with refused messages among them, chosen by model (event_type).

    Request R at ``ts``, response S at ts+5ms. click: after R a request of unequal
    tensors and one with text after the object; view: before S a response with an
    unreadable ``ce_time``, one without and one with a time but no date; signup: S has
    no ``ce_time``; purchase: R is truncated; error: S comes in two copies with a null
    position, between them a body that is a list. Requests at ts+6ms and later, one of
    each kind for each error event, are objects with text after a comma or a brace.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    et = F.col("event_type")
    req = F.to_json(F.struct(F.array(F.array("user_id")).alias("instances")))
    resp = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.array("value").alias("predictions")))
    unequal = F.lit('{"inputs":[{"name":"p","shape":[1],"data":[1]},{"name":"q","shape":[2],"data":[1,2]}]}')

    listed = F.concat(F.lit("["), resp, F.lit("]"))
    bodies = [F.when(et == "purchase", F.lit('{"instances": [[')).otherwise(req), unequal, F.concat(req, F.lit(" and more")), resp, listed,
              *[F.concat(req, F.lit(text)) for text in APPENDED]]

    def item(kind, ms, body, time="good", placed=True, when=None):
        s = F.struct(F.lit(kind).alias("kind"), F.lit(ms).alias("ms"), F.lit(body).alias("body"), F.lit(time).alias("time"), F.lit(placed).alias("placed"))
        return s if when is None else F.when(when, s)

    # an item names its body by number: the text is made after the explode, and not for a reader of other columns
    items = F.array_compact(F.array(
        item("R", 0, 0),
        item("R", 1, 1, when=et == "click"),
        item("R", 2, 2, when=et == "click"),
        item("S", 2, 3, "yesterday", when=et == "view"),
        item("S", 3, 3, None, when=et == "view"),
        item("S", 4, 3, "12:30:00", when=et == "view"),
        item("S", 4, 4, placed=False, when=et == "error"),
        item("S", 4, 4, placed=False, when=et == "error"),
        item("S", 5, 3, placed=False, when=et == "error"),
        *[item("R", 6 + i, 5 + i, when=et == "error") for i in range(len(APPENDED))],
        F.when(et != "error", F.struct(
            F.lit("S").alias("kind"), F.lit(5).alias("ms"), F.lit(3).alias("body"),
            F.when(et == "signup", F.lit(None).cast("string")).otherwise("good").alias("time"), F.lit(True).alias("placed")))))
    x = ev.select("*", F.posexplode(items).alias("pos", "e"))
    body = functools.reduce(lambda b, i: b.when(F.col("e.body") == i, bodies[i]), range(1, len(bodies)), F.when(F.col("e.body") == 0, bodies[0]))
    ce_id, at = F.concat(F.lit("evt-"), F.col("event_id").cast("string")), F.col("ts") + F.make_dt_interval(secs=F.col("e.ms") / 1000.0)
    time = F.when(F.col("e.time") == "good", format_iso(at)).otherwise(F.col("e.time"))
    headers = (F.when(F.col("e.kind") == "R", _headers(ce_id, F.lit(REQUEST_TYPE)))
               .when(time.isNull(), _headers(ce_id, F.lit(RESPONSE_TYPE))).otherwise(_headers(ce_id, F.lit(RESPONSE_TYPE), time)))
    out = x.select(*envelope(body, ce_id, headers, at, F.col("event_id") * 16 + F.col("pos"), "kserve"), F.col("e.placed").alias("placed"))
    return (out.withColumn("offset", F.when(F.col("placed"), F.col("offset"))).withColumn("partition", F.when(F.col("placed"), F.col("partition"))).drop("placed"))


def column_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` -> JSON events whose inputs and outputs are dicts of columns; Spanish ones have unequal columns."""
    d = table(spark, sf_dir, "documents")
    body = F.concat(
        F.lit('{"id":"'), F.col("doc_id").cast("string"), F.lit('","inputs":{"source":["'), F.col("source"), F.lit('","'), F.col("lang"),
        F.lit('"],"chars":['), F.col("n_chars").cast("string"),
        F.when(F.col("lang") == "es", F.lit("")).otherwise(F.concat(F.lit(","), (F.col("n_chars") + 1).cast("string"))),
        F.lit(']},"outputs":{"half":['), (F.col("n_chars") / 2).cast("string"), F.lit(","), (F.col("n_chars") / 4).cast("string"), F.lit("]}}"))
    ts = F.lit(EMBED_TS).cast("timestamp") + F.make_dt_interval(secs=F.col("doc_id"))
    return d.select(*envelope(body, F.col("doc_id"), _headers(F.col("doc_id").cast("string")), ts, F.col("doc_id"), topic="documents"))
