"""The registered queries (one per operator group of the survey) and their oracles.

Each query derives its envelopes from a base table with Spark, runs the
library's operators over the whole table, and returns a DataFrame. Each
oracle computes the expected answer directly from the base table in DuckDB
SQL, sharing no code with the Spark side.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from predlake.operators.correlate import kserve_inferences
from predlake.operators.json_events import parse_json_events
from predlake.plans import feeds
from predlake.plans.logger import datapoints
from predlake.session import apply_defaults, release_kept

# The functions that a query hands to Spark go by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query. What the query before it has persisted is released when it starts."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            release_kept()
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _iso(col: str) -> str:
    """DuckDB: Python-style isoformat() of a UTC timestamp."""
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN epoch_us({col}) % 1000000 = 0 "
            f"THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') || '+00:00' "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END")


# --- json_flatten: S3 P1 P6 P11 P12 D1 D2 ---------------------------------------

@query("json_flatten", f"""
SELECT CAST(event_id AS VARCHAR) || '_0' AS id,
       {_iso('ts')} AS occurred_at,
       user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       value
FROM events
""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    inf = parse_json_events(feeds.json_events(spark, sf_dir))
    return datapoints(inf).good


# --- wide_merge: P12 ---------------------------------------------------------------------

@query("wide_merge", f"""
SELECT CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('ts')} AS occurred_at,
       CASE WHEN event_type <> 'view' THEN value END AS score, user_id, CAST(1 AS BIGINT) AS rank
FROM events
""")
def wide_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of both sides keeps the input's place and has the output's value, null where an output lacks it."""
    apply_defaults(spark)
    return datapoints(parse_json_events(feeds.clashing_events(spark, sf_dir))).good


# --- correlate: S2 F7 J1 W1 P8 P2 P3 P6 P9 -------------------------------------

def _resp_ts(alias: str = "") -> str:
    return f"({alias}ts + to_milliseconds(({alias}event_id * 7919) % 12000))"


@query("correlate", f"""
SELECT CAST(event_id AS VARCHAR) || '_0' AS id,
       {_iso(_resp_ts())} AS occurred_at,
       user_id AS X0,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS X1,
       value AS Y0
FROM events
WHERE floor(epoch_us(ts) / 10000000) = floor(epoch_us({_resp_ts()}) / 10000000)
""")
def correlate(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    inf = kserve_inferences(feeds.kserve_pairs(spark, sf_dir))
    return datapoints(inf).good


# --- lineitem: V1 and V2 multi-row payloads -------------------------------------

_CHUNKS = """
WITH l AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rn
  FROM lineitem),
c AS (SELECT *, rn // 16 AS chunk, rn % 16 AS i FROM l),
m AS (SELECT l_orderkey, chunk, max(l_shipdate) AS ts, max(l_returnflag) AS max_flag,
             count(*) AS n
      FROM c GROUP BY l_orderkey, chunk)
"""
_CHUNK_ID = "'o' || c.l_orderkey || '-' || c.chunk || '_' || c.i"


@query("v1_rows", f"""{_CHUNKS}
SELECT {_CHUNK_ID} AS id, {_iso('m.ts')} AS occurred_at,
       c.l_quantity AS X0, c.l_extendedprice AS X1, c.l_discount AS Y0
FROM c JOIN m USING (l_orderkey, chunk)
""")
def v1_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 list rows and scalar predictions per message."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.v1_orders(spark, sf_dir))).good


@query("zip_truncate", f"""{_CHUNKS}
SELECT {_CHUNK_ID} AS id, {_iso('m.ts')} AS occurred_at,
       c.l_quantity AS X0, c.l_extendedprice AS X1, c.l_discount AS Y0
FROM c JOIN m USING (l_orderkey, chunk)
WHERE NOT (m.max_flag = 'R' AND c.i = m.n - 1)
""")
def zip_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer predictions than instances -> rows truncated to the shorter side."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.v1_orders(spark, sf_dir, truncate_flag="R"))).good


@query("v2_named", f"""{_CHUNKS}
SELECT {_CHUNK_ID} AS id, {_iso('m.ts')} AS occurred_at,
       c.l_quantity AS quantity, c.l_returnflag AS returnflag,
       CAST(c.l_linenumber AS BIGINT) AS linenumber, c.l_tax AS tax
FROM c JOIN m USING (l_orderkey, chunk)
""")
def v2_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 named tensors (FP64, BYTES, INT32) transposed to rows."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.v2_orders(spark, sf_dir))).good


# --- embeddings: matrix tensors ----------------------------------------------------

def _embed_ts() -> str:
    return f"(TIMESTAMP '{feeds.EMBED_TS}' + to_seconds(vec_id))"


def _embed_cols(prefix: str) -> str:
    return ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {prefix}{i}" for i in range(64))


@query("v2_matrix", f"""
SELECT 'vec-' || vec_id || '_0' AS id, {_iso(_embed_ts())} AS occurred_at,
       {_embed_cols('X')}, CAST(label AS BIGINT) AS label
FROM embeddings
""")
def v2_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 2-D tensor -> its rows, positional columns X0..X63."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.v2_matrix(spark, sf_dir))).good


OVERRIDE_INPUTS = [f"f{i}" for i in range(64)]


@query("names_override", f"""
SELECT 'vec-' || vec_id || '_0' AS id, {_iso(_embed_ts())} AS occurred_at,
       {_embed_cols('f')}, CAST(label AS BIGINT) AS target
FROM embeddings
""")
def names_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: columnNames override by position (inputs f0..f63, outputs target)."""
    apply_defaults(spark)
    inf = kserve_inferences(feeds.v2_matrix(spark, sf_dir))
    return datapoints(inf, input_names=OVERRIDE_INPUTS, output_names=["target"]).good


@query("v2_text_embedding", f"""
SELECT 'vec-' || vec_id || '_0' AS id, {_iso(_embed_ts())} AS occurred_at,
       'vec-' || vec_id AS text, CAST(embedding AS DOUBLE[]) AS embedding,
       CAST(label AS BIGINT) AS label
FROM embeddings
""")
def v2_text_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2-D tensor among several becomes a list cell."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.v2_text_embedding(spark, sf_dir))).good


# --- documents + labels: dict rows ----------------------------------------------------

_DOC_TS = f"(TIMESTAMP '{feeds.EMBED_TS}' + to_seconds(d.doc_id))"


@query("row_shapes", f"""
SELECT CAST(d.doc_id AS VARCHAR) || '_0' AS id, {_iso(_DOC_TS)} AS occurred_at,
       d.n_chars AS n_chars, d.lang AS lang, CAST(NULL AS VARCHAR) AS source,
       CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL
SELECT CAST(d.doc_id AS VARCHAR) || '_1' AS id, {_iso(_DOC_TS)} AS occurred_at,
       CAST(NULL AS BIGINT) AS n_chars, d.lang AS lang, d.source AS source,
       CAST(NULL AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def row_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dict rows with missing keys and keys out of order; union of keys."""
    apply_defaults(spark)
    return datapoints(parse_json_events(feeds.document_events(spark, sf_dir))).good


# --- conversations ------------------------------------------------------------------------

@query("correlate_turns", f"""
SELECT 'c' || u.conv_id || '-' || u.turn || '_0' AS id,
       {_iso(f"(TIMESTAMP '{feeds.EMBED_TS}' + to_minutes(CAST(u.conv_id AS INTEGER)))")} AS occurred_at,
       u.text AS X0, a.text AS Y0
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
def correlate_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn paired with the assistant turn that answers it."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.conversation_turns(spark, sf_dir))).good


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# --- filters and fan-out --------------------------------------------------------------------

_CORRELATED = f"""
SELECT *, {_resp_ts()} AS rts FROM events
WHERE floor(epoch_us(ts) / 10000000) = floor(epoch_us({_resp_ts()}) / 10000000)
"""


@query("model_filters", f"""
SELECT CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('rts')} AS occurred_at,
       user_id AS X0, CAST(json_extract_string(props, '$.k') AS BIGINT) AS X1, value AS Y0
FROM ({_CORRELATED}) WHERE event_type = 'click' AND coalesce({_K} % 3 <> 0, TRUE)
""")
def model_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep one model name and version; keys without such a response are left out before the exchange."""
    from predlake.operators.filters import filter_models
    apply_defaults(spark)
    inf = filter_models(kserve_inferences(feeds.kserve_pairs(spark, sf_dir), model_name="click", model_version="v1"), "click", "v1")
    return datapoints(inf).good


FAN_OUT_SPECS = [
    {"name": "view-logger", "topic": "kserve", "events": {"type": "kserve", "config": {}},
     "schema": {"type": "avro", "config": {"columnNames": {"inputs": ["user", "k"], "outputs": ["score"]}}},
     "filters": {"modelName": "view"},
     "destination": {"type": "parquet", "config": {"url": ""}}},
    {"name": "purchase-logger", "topic": "kserve", "events": {"type": "kserve", "config": {}},
     "filters": {"modelName": "purchase", "modelVersion": "v1"},
     "destination": {"type": "parquet", "config": {"url": ""}}},
]


@query("fan_out", f"""
SELECT CASE event_type WHEN 'view' THEN 'view-logger' ELSE 'purchase-logger' END AS logger,
       CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('rts')} AS occurred_at
FROM ({_CORRELATED}) WHERE event_type = 'view' OR (event_type = 'purchase' AND coalesce({_K} % 3 <> 0, TRUE))
""")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 M2: two loggers on one topic, each with its own filter and names."""
    from predlake.plans.logger import fan_out as run_fan_out
    from predlake.plans.spec import LoggerSpec
    apply_defaults(spark)
    specs = [LoggerSpec.from_dict(d) for d in FAN_OUT_SPECS]
    return run_fan_out(specs, feeds.kserve_pairs(spark, sf_dir)).rows.select("logger", "id", "occurred_at")


# --- flagship --------------------------------------------------------------------------------

@query("entry_model_hours", f"""
SELECT event_type AS model_name, date_trunc('hour', rts) AS hour,
       count(*) AS inferences, count(*) AS datapoints
FROM ({_CORRELATED}) GROUP BY event_type, date_trunc('hour', rts)
""")
def entry_model_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlated KServe traffic counted per model and hour (inferences, datapoints)."""
    from pyspark.sql import functions as F
    apply_defaults(spark)
    inf = kserve_inferences(feeds.kserve_pairs(spark, sf_dir), with_rejects=False)
    from predlake.functions.barrier import where
    return (where(inf, F.col("_reason").isNull())
            .groupBy("model_name", F.date_trunc("hour", "occurred_at").alias("hour"))
            .agg(F.count(F.lit(1)).alias("inferences"),
                 F.sum(F.least(F.size("inputs.rows"), F.size("outputs.rows"))).alias("datapoints")))


# --- quarantine, timestamps, schema ------------------------------------------------------------


@query("event_validity", f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'missing_event_id'
              WHEN event_type = 'signup' THEN 'null_body'
              WHEN event_type = 'view' THEN 'response_without_id'
              WHEN event_type = 'click' THEN 'no_instances_or_inputs'
              WHEN {_K} >= 90 THEN 'malformed_body'
              WHEN {_K} < 10 THEN 'unknown_event_type' END AS reason
  FROM events) WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'paired' AS reason, count(*) AS n FROM ({_CORRELATED})
WHERE event_type = 'purchase' AND {_K} >= 10 AND {_K} < 90
""")
def event_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every refused envelope gets a reason; good pairs counted."""
    from pyspark.sql import functions as F
    apply_defaults(spark)
    inf = kserve_inferences(feeds.broken_pairs(spark, sf_dir))
    return (inf.groupBy(F.coalesce(F.col("_reason"), F.lit("paired")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("iso_times", f"""
SELECT CAST(event_id AS VARCHAR) || '_0' AS id,
       CASE event_type WHEN 'signup' THEN {_iso("date_trunc('second', ts)")}
                       WHEN 'purchase' THEN {_iso("date_trunc('day', ts)")}
                       ELSE {_iso('ts')} END AS occurred_at,
       event_id AS e, value AS v
FROM events WHERE event_type <> 'error'
""")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z, offset, basic and date-only forms parsed; output as UTC ISO text."""
    apply_defaults(spark)
    return datapoints(parse_json_events(feeds.iso_time_events(spark, sf_dir))).good



@query("schema_enforce", """
SELECT CASE WHEN event_type = 'error' THEN 'type_mismatch' ELSE 'ok' END AS reason,
       count(*) AS n
FROM events GROUP BY 1
""")
def schema_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 Q1: a pinned schema (code BIGINT); text codes do not cast -> quarantine."""
    from pyspark.sql import functions as F
    from predlake.operators.schema import PinnedSchema
    apply_defaults(spark)
    pinned = PinnedSchema([("user_id", "bigint"), ("code", "bigint")], [("value", "double")])
    logged = datapoints(parse_json_events(feeds.mixed_type_events(spark, sf_dir)), schema=pinned)
    return (logged.rows.groupBy(F.coalesce(F.col("_reason"), F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


_LOGGED_TYPE = "CASE typeof(any_value({0})) WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'bigint' END"


@query("schema_infer", " UNION ALL ".join(
    f"SELECT '{side}' AS side, {pos} AS pos, '{col[2:]}' AS name, {_LOGGED_TYPE.format(col)} AS type FROM lineitem"
    for side, pos, col in (("inputs", 0, "l_quantity"), ("inputs", 1, "l_returnflag"), ("inputs", 2, "l_linenumber"), ("outputs", 0, "l_tax"))))
def schema_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infer from the V2 feed, register in a catalog table, read it back."""
    from predlake.operators.rows import name_columns
    from predlake.operators.schema import lookup, resolve
    from predlake.session import scratch_folder
    apply_defaults(spark)
    catalog = scratch_folder(spark, "schema-catalog")
    named = name_columns(kserve_inferences(feeds.v2_orders(spark, sf_dir)))
    resolve(named, catalog, "lineitem-v2-value")            # C1 + C2
    found = lookup(spark, catalog, "lineitem-v2-value")     # C3
    rows = [(side, i, n, t) for side, cols in (("inputs", found.inputs), ("outputs", found.outputs))
            for i, (n, t) in enumerate(cols)]
    return spark.createDataFrame(rows, "side string, pos int, name string, type string")


@query("schema_first_seen", f"""
WITH first AS (SELECT arg_min(event_type = 'click', (ts, CAST(event_id AS VARCHAR))) AS text_first FROM events WHERE {_K} IS NOT NULL)
SELECT CASE WHEN event_type = 'click' AND NOT text_first AND {_K} IS NOT NULL THEN 'type_mismatch' ELSE 'ok' END AS reason,
       CASE WHEN text_first THEN 'string' ELSE 'bigint' END AS code_type, count(*) AS n
FROM events, first GROUP BY 1, 2
""")
def schema_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that mixes numbers and text is pinned by its first cell; cells of the other kind are refused."""
    from pyspark.sql import functions as F
    apply_defaults(spark)
    logged = datapoints(parse_json_events(feeds.mixed_type_events(spark, sf_dir, text="click")))
    code = dict(logged.schema.inputs)["code"]
    return (logged.rows.groupBy(F.coalesce(F.col("_reason"), F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("code_type", F.lit(code)))


# --- streaming ----------------------------------------------------------------------------------

DELIVERIES = 3   # a replay delivers the feed in so many parts of its time, each before a run of the stream


def _stream_spec(name: str, url: str, events: str = "kserve", config: dict | None = None, **more) -> dict:
    return {"name": name, "topic": "kserve", "events": {"type": events, "config": config or {}},
            "destination": {"type": "parquet", "config": {"url": url, "maxRecordsPerFile": 100000}}, **more}


def _stream_run(spark: SparkSession, sf_dir: str, feed=feeds.kserve_pairs, specs=None, order=range(DELIVERIES),
                quarantine: bool = False, pinned: bool = True, between=None) -> str:
    """Stage a feed in parts of its time, deliver them in ``order``, each to a run of the stream on one checkpoint; the folder of all.

    ``pinned``: the schemas are inferred before the first run; otherwise by the stream itself.
    ``between`` is called after every run.
    """
    from predlake.plans.spec import LoggerSpec
    from predlake.sources.envelopes import deliver_slice, stage_slices, stream_envelopes
    from predlake.streaming.logger import pin_schemas, run_loggers, scratch
    apply_defaults(spark)
    base = scratch(spark, "stream")
    loggers = [LoggerSpec.from_dict(d) for d in (specs or [_stream_spec("kserve-stream", "")])]
    for s in loggers:
        s.destination.config["url"] = f"{base}/lake"
    stage_slices(feed(spark, sf_dir), f"{base}/staged", DELIVERIES)
    schemas = pin_schemas(spark, loggers, f"{base}/staged", catalog=f"{base}/catalog") if pinned else None
    for i in order:
        deliver_slice(spark, f"{base}/staged", i, f"{base}/landing")
        run_loggers(loggers, stream_envelopes(spark, f"{base}/landing"), schemas, f"{base}/checkpoint",
                    quarantine_url=f"{base}/quarantine" if quarantine else None, catalog=f"{base}/catalog").awaitTermination()
        if between:
            between(base)
    return base


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    from predlake.sinks.parquet import BATCH
    return spark.read.parquet(folder).drop(BATCH)


@query("stream_correlate", ORACLES["correlate"])
def stream_correlate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 X1 W1 W2 ST1 ST2 K2: the correlate feed as a stream, landed and read back."""
    return _landed(spark, f"{_stream_run(spark, sf_dir)}/lake/kserve-stream")


_SPAN = f"""
span AS (SELECT least(min(epoch_us(ts)), min(epoch_us({_resp_ts()}))) AS lo, greatest(max(epoch_us(ts)), max(epoch_us({_resp_ts()}))) AS hi FROM events)"""
_PART = f"CAST(least(floor((epoch_us(%s) - lo) * {DELIVERIES} / (hi - lo + 1)), {DELIVERIES - 1}) AS INTEGER)"


@query("stream_late", f"""
WITH {_SPAN}
SELECT CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('rts')} AS occurred_at, user_id AS X0, {_K} AS X1, value AS Y0
FROM ({_CORRELATED}), span
WHERE {_PART % 'ts'} <> 1 AND {_PART % 'rts'} <> 1
""")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle part is delivered last; its windows have expired by then, so
    its pairs are not logged, as in a stream processor."""
    return _landed(spark, f"{_stream_run(spark, sf_dir, order=(0, 2, 1))}/lake/kserve-stream")


# What becomes of every message, from the order of delivery: the clock of a run is the newest message of the runs before.
_DELIVERED = f"""
WITH {_SPAN},
msg AS (
  SELECT event_id, 'R' AS kind, event_id * 2 AS off, epoch_us(ts) AS t, {_PART % 'ts'} AS part FROM events, span
  UNION ALL SELECT event_id, 'S', event_id * 2 + 1, epoch_us({_resp_ts()}), {_PART % _resp_ts()} FROM events, span),
run AS (SELECT part, CASE part WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS run, max(t) AS newest FROM msg GROUP BY part),
clock AS (SELECT part, max(newest) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS now FROM run),
seen AS (
  SELECT msg.*, floor(t / 10000000) AS win, coalesce((floor(t / 10000000) + 2) * 10000000 <= now, FALSE) AS late FROM msg JOIN clock USING (part)),
fate AS (
  SELECT s.*, CASE WHEN late THEN 'window_expired'
                   WHEN count(*) FILTER (WHERE NOT late) OVER (PARTITION BY event_id, win) = 2 THEN 'paired'
                   WHEN (win + 2) * 10000000 <= hi THEN 'window_expired' ELSE 'pending' END AS outcome
  FROM seen s, span)"""


@query("stream_late_rows", f"""{_DELIVERED}
SELECT event_id, kind, outcome FROM fate
""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts delivered out of order; every message is in a pair, pending, or came out as window_expired."""
    from pyspark.sql import functions as F
    from predlake.streaming.correlate import pending_messages
    base = _stream_run(spark, sf_dir, order=(0, 2, 1), quarantine=True)
    event_id = F.substring_index("event_id", "-", -1).cast("long").alias("event_id")
    paired = _landed(spark, f"{base}/lake/kserve-stream").select(
        F.substring_index("id", "_", 1).cast("long").alias("event_id"), F.explode(F.array(F.lit("R"), F.lit("S"))).alias("kind"), F.lit("paired").alias("outcome"))
    expired = (_landed(spark, f"{base}/quarantine/expired")
               .select(event_id, F.when(F.col("offset") % 2 == 0, "R").otherwise("S").alias("kind"), F.col("reason").alias("outcome")))
    waiting = pending_messages(spark, f"{base}/checkpoint").select(event_id, "kind", F.lit("pending").alias("outcome"))
    return paired.unionByName(expired).unionByName(waiting)


@query("stream_pending", f"""
SELECT event_id, 'R' AS kind, make_timestamp(epoch_us(ts)) AS at FROM events
WHERE floor(epoch_us(ts) / 10000000) <> floor(epoch_us({_resp_ts()}) / 10000000)
UNION ALL
SELECT event_id, 'S', make_timestamp(epoch_us({_resp_ts()})) FROM events
WHERE floor(epoch_us(ts) / 10000000) <> floor(epoch_us({_resp_ts()}) / 10000000)
""")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 ST2: what waits for its other side after the run, read from the state; windows are kept for a year here."""
    from pyspark.sql import functions as F
    from predlake.streaming.correlate import pending_messages
    base = _stream_run(spark, sf_dir, specs=[_stream_spec("kserve-stream", "", config={"expires": "365 days"})])
    return pending_messages(spark, f"{base}/checkpoint").select(
        F.substring_index("event_id", "-", -1).cast("long").alias("event_id"), "kind", F.col("timestamp").cast("timestamp_ntz").alias("at"))


# --- schemas of live streams ------------------------------------------------------------------

@query("stream_first_schema", ORACLES["schema_first_seen"])
def stream_first_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 C2 C3 in a live stream: pinned by the first micro-batch, found in the catalog by the later runs."""
    from pyspark.sql import functions as F
    from predlake.operators.schema import lookup

    def feed(spark, sf_dir):
        return feeds.mixed_type_events(spark, sf_dir, text="click")
    base = _stream_run(spark, sf_dir, feed, [_stream_spec("typed", "", "json")], quarantine=True, pinned=False)
    code = dict(lookup(spark, f"{base}/catalog", "typed-value").inputs)["code"]
    outcomes = (_landed(spark, f"{base}/lake/typed").select(F.lit("ok").alias("reason"))
                .unionByName(_landed(spark, f"{base}/quarantine/typed").select("reason")))
    return outcomes.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("code_type", F.lit(code))


_EVOLVED = f"""
WITH {_SPAN.replace(_resp_ts(), 'ts')},
e AS (SELECT *, {_PART % 'ts'} AS part, {_K} AS k FROM events, span)
SELECT CASE WHEN part = 2 AND event_type = 'click' AND k IS NOT NULL THEN 'type_mismatch' ELSE 'ok' END AS reason,
       CASE WHEN part = 2 AND event_type = 'click' AND k IS NOT NULL THEN 0 WHEN part = 0 THEN 1 ELSE 2 END AS version, count(*) AS n,
       sum(CASE WHEN part = 2 AND event_type = 'click' THEN NULL WHEN part = 1 THEN k + 0.5 ELSE CAST(k AS DOUBLE) END) AS codes,
       count(CASE WHEN part > 0 AND NOT (part = 2 AND event_type = 'click' AND k IS NOT NULL) THEN event_type END) AS regions
FROM e GROUP BY 1, 2
"""


@query("schema_evolve", _EVOLVED)
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added and an integer widened mid-feed are logged under version 2; text in its place is refused."""
    from pyspark.sql import functions as F
    from predlake.operators.schema import lookup
    from predlake.sinks.parquet import VERSION, read_versions
    spec = _stream_spec("grown", "", "json", schema={"type": "evolving"})
    base = _stream_run(spark, sf_dir, feeds.growing_events, [spec], quarantine=True, pinned=False)
    last = lookup(spark, f"{base}/catalog", "grown-value").version
    schemas = [lookup(spark, f"{base}/catalog", "grown-value", v) for v in range(1, last + 1)]
    rows = read_versions(spark, f"{base}/lake/grown", schemas)
    logged = rows.select(F.lit("ok").alias("reason"), F.col(VERSION).alias("version"), "code", "region")
    refused = _landed(spark, f"{base}/quarantine/grown").select("reason", F.lit(0).alias("version"), F.lit(None).cast("double").alias("code"),
                                                               F.lit(None).cast("string").alias("region"))
    return (logged.unionByName(refused).groupBy("reason", "version")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("code").alias("codes"), F.count("region").alias("regions")))


@query("stream_fan_out", f"""
SELECT CASE event_type WHEN 'view' THEN 'views' ELSE 'purchases' END AS logger,
       CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('rts')} AS occurred_at, value AS score
FROM ({_CORRELATED}) WHERE event_type = 'view' OR (event_type = 'purchase' AND coalesce({_K} % 3 <> 0, TRUE))
""")
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 as a stream: two loggers with filters and names of their own on one stateful pass."""
    from pyspark.sql import functions as F
    names = {"type": "avro", "config": {"columnNames": {"inputs": ["user", "k"], "outputs": ["score"]}}}
    specs = [_stream_spec("views", "", filters={"modelName": "view"}, schema=names),
             _stream_spec("purchases", "", filters={"modelName": "purchase", "modelVersion": "v1"}, schema=names)]
    base = _stream_run(spark, sf_dir, specs=specs)
    parts = [_landed(spark, f"{base}/lake/{s['name']}").select(F.lit(s["name"]).alias("logger"), "id", "occurred_at", "score") for s in specs]
    return parts[0].unionByName(parts[1])


# --- repeats: the exact fold, checked by a recursive CTE -------------------------------------

_REPEAT_EVENTS = f"""
WITH RECURSIVE base AS (
  SELECT event_id, event_type, ts, user_id, value, {_K} AS k,
         (event_id * 7919) % 12000 AS delay FROM events),
ev0 AS (
  SELECT event_id, 'R' AS kind, ts AS ets, 0 AS off, user_id, k AS x1, value AS y0, TRUE AS rid FROM base
  UNION ALL SELECT event_id, 'S', ts + to_milliseconds(delay), 1, user_id, k, value, TRUE FROM base
  UNION ALL SELECT event_id, 'R', ts + to_milliseconds(1), 2, user_id, k + 1000, value, TRUE
            FROM base WHERE event_type = 'click'
  UNION ALL SELECT event_id, 'S', ts + to_milliseconds(delay + 2), 3, user_id, k, value + 1, TRUE
            FROM base WHERE event_type = 'view'
  UNION ALL SELECT event_id, 'S', ts - to_milliseconds(1), 4, user_id, k, value + 2, FALSE
            FROM base WHERE event_type = 'signup'
  UNION ALL SELECT event_id, 'S', ts + to_milliseconds(delay // 2), 5, user_id, k, value, FALSE
            FROM base WHERE event_type = 'purchase'
  UNION ALL SELECT event_id, 'S', ts + to_milliseconds(delay + 3), 6, user_id, k, value, FALSE
            FROM base WHERE event_type = 'error'),
ev AS (
  SELECT *, floor(epoch_us(ets) / 10000000) AS bucket,
         row_number() OVER (PARTITION BY event_id, floor(epoch_us(ets) / 10000000)
                            ORDER BY ets, off) AS rn
  FROM ev0),
fold AS (
  SELECT event_id, bucket, 0 AS rn,
         NULL::STRUCT(x0 BIGINT, x1 BIGINT) AS r,
         NULL::STRUCT(y0 DOUBLE, t TIMESTAMP, rid BOOLEAN) AS s,
         NULL::STRUCT(x0 BIGINT, x1 BIGINT) AS out_r,
         NULL::STRUCT(y0 DOUBLE, t TIMESTAMP, rid BOOLEAN) AS out_s
  FROM (SELECT DISTINCT event_id, bucket FROM ev)
  UNION ALL
  SELECT event_id, bucket, rn,
         CASE WHEN emit THEN NULL ELSE nr END, CASE WHEN emit THEN NULL ELSE ns END,
         CASE WHEN emit THEN nr END, CASE WHEN emit THEN ns END
  FROM (
    SELECT f.event_id, f.bucket, e.rn,
           CASE WHEN e.kind = 'R' THEN {{'x0': e.user_id, 'x1': e.x1}} ELSE f.r END AS nr,
           CASE WHEN e.kind = 'S' THEN {{'y0': e.y0, 't': e.ets, 'rid': e.rid}} ELSE f.s END AS ns,
           (CASE WHEN e.kind = 'R' THEN TRUE ELSE f.r IS NOT NULL END)
             AND (CASE WHEN e.kind = 'S' THEN e.rid ELSE coalesce(f.s.rid, FALSE) END) AS emit
    FROM fold f JOIN ev e ON e.event_id = f.event_id AND e.bucket = f.bucket AND e.rn = f.rn + 1))
"""


@query("correlate_repeats", f"""{_REPEAT_EVENTS}
SELECT CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('out_s.t')} AS occurred_at,
       out_r.x0 AS X0, out_r.x1 AS X1, out_s.y0 AS Y0
FROM fold WHERE out_r IS NOT NULL
""")
def correlate_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 J1 ST1 B14 B15: repeats overwrite (last write wins), null ids never
    complete, a completed pair clears the state."""
    apply_defaults(spark)
    return datapoints(kserve_inferences(feeds.repeated_pairs(spark, sf_dir))).good


# --- hot keys: a whole feed on three ids and one window ---------------------------------------

HOT_WINDOW, HOT_QUERY_ROWS = "3650 days", 2000

_HOT_EVENTS = f"""
WITH RECURSIVE base AS (
  SELECT event_id, event_type, ts, coalesce(user_id % 2, 0) = 1 AS odd, coalesce({_K} % 7 = 0, FALSE) AS null_id FROM events),
ev0 AS (
  SELECT event_id, 0 AS again, ts AS ets, CASE WHEN odd THEN 'S' ELSE 'R' END AS kind, null_id FROM base
  UNION ALL SELECT event_id, 1, ts + to_milliseconds(3), CASE WHEN odd THEN 'R' ELSE 'S' END, null_id FROM base WHERE event_type = 'click'),
ev AS MATERIALIZED (
  SELECT event_id % 3 AS key, floor(epoch_us(ets) / {3650 * 86_400_000_000}) AS bucket, event_id, ets, CASE WHEN kind = 'S' AND null_id THEN 'N' ELSE kind END AS kind,
         row_number() OVER (PARTITION BY event_id % 3, floor(epoch_us(ets) / {3650 * 86_400_000_000})
                            ORDER BY ets, hash_partition, event_id * 2 + again) AS rn
  FROM (SELECT *, 0 AS hash_partition FROM ev0)),
fold AS (
  SELECT key, bucket, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS r, CAST(NULL AS BIGINT) AS s, FALSE AS ok, CAST(NULL AS TIMESTAMP) AS at, FALSE AS emit,
         CAST(NULL AS BIGINT) AS out_r, CAST(NULL AS BIGINT) AS out_s
  FROM (SELECT DISTINCT key, bucket FROM ev)
  UNION ALL
  SELECT key, bucket, rn, CASE WHEN emit THEN NULL ELSE nr END, CASE WHEN emit THEN NULL ELSE ns END, nok AND NOT emit, ets, emit, nr, ns
  FROM (SELECT *, nr IS NOT NULL AND ns IS NOT NULL AND nok AS emit
        FROM (SELECT f.key, f.bucket, e.rn, e.ets, CASE WHEN e.kind = 'R' THEN e.event_id ELSE f.r END AS nr,
                     CASE WHEN e.kind = 'R' THEN f.s ELSE e.event_id END AS ns, CASE WHEN e.kind = 'R' THEN f.ok ELSE e.kind = 'S' END AS nok
              FROM fold f JOIN ev e ON e.key = f.key AND e.bucket = f.bucket AND e.rn = f.rn + 1)))
"""


@query("correlate_hot_key", f"""{_HOT_EVENTS}
SELECT CAST(out_s AS VARCHAR) || '_0' AS id, out_r AS X0, out_s AS Y0 FROM fold WHERE emit
""")
def correlate_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on three ids in one window; slices of a key are folded side by side."""
    apply_defaults(spark)
    inf = kserve_inferences(feeds.hot_pairs(spark, sf_dir), HOT_WINDOW, hot_rows=HOT_QUERY_ROWS)
    return datapoints(inf).good.select("id", "X0", "Y0")


@query("stream_parquet", ORACLES["json_flatten"])
def stream_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events as a stateless stream into the Parquet lake, read back."""
    base = _stream_run(spark, sf_dir, feeds.json_events, [_stream_spec("json-stream", "", "json")])
    return _landed(spark, f"{base}/lake/json-stream")


# --- refused messages never take a good one's place -------------------------------------------

_REFUSED = """
WITH RECURSIVE base AS (SELECT event_id, event_type, ts, value, user_id FROM events),
ev0 AS (
  SELECT event_id, 0 AS ms, 'R' AS kind, CASE WHEN event_type = 'purchase' THEN 'malformed_body' END AS bad, ts FROM base
  UNION ALL SELECT event_id, 1, 'R', 'unequal_tensor_lengths', ts FROM base WHERE event_type = 'click'
  UNION ALL SELECT event_id, 2, 'R', 'malformed_body', ts FROM base WHERE event_type = 'click'
  UNION ALL SELECT event_id, 2, 'S', 'bad_event_time', ts FROM base WHERE event_type = 'view'
  UNION ALL SELECT event_id, 3, 'S', 'missing_event_time', ts FROM base WHERE event_type = 'view'
  UNION ALL SELECT event_id, 4, 'S', 'bad_event_time', ts FROM base WHERE event_type = 'view'
  UNION ALL SELECT event_id, 4, 'S', 'malformed_body', ts FROM base, (VALUES (1), (2)) AS twice(n) WHERE event_type = 'error'
  UNION ALL SELECT event_id, 6, 'R', 'malformed_body', ts FROM base, range(5) WHERE event_type = 'error'
  UNION ALL SELECT event_id, 5, 'S', CASE WHEN event_type = 'signup' THEN 'missing_event_time' END, ts FROM base),
good AS (
  SELECT event_id, kind, floor((epoch_us(ts) + ms * 1000) / 10000000) AS bucket,
         row_number() OVER (PARTITION BY event_id, floor((epoch_us(ts) + ms * 1000) / 10000000) ORDER BY ms) AS rn
  FROM ev0 WHERE bad IS NULL),
fold AS (
  SELECT event_id, bucket, 0 AS rn, FALSE AS r, FALSE AS s, FALSE AS emit FROM (SELECT DISTINCT event_id, bucket FROM good)
  UNION ALL
  SELECT event_id, bucket, rn, nr AND NOT (nr AND ns), ns AND NOT (nr AND ns), nr AND ns
  FROM (SELECT f.event_id, f.bucket, g.rn, f.r OR g.kind = 'R' AS nr, f.s OR g.kind = 'S' AS ns
        FROM fold f JOIN good g ON g.event_id = f.event_id AND g.bucket = f.bucket AND g.rn = f.rn + 1))
"""


@query("correlate_refused", f"""{_REFUSED}
SELECT 'paired' AS outcome, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM fold JOIN base USING (event_id) WHERE emit GROUP BY event_type
UNION ALL
SELECT bad, event_type, count(*), CAST(sum(event_id) AS BIGINT) FROM ev0 JOIN base USING (event_id) WHERE bad IS NOT NULL GROUP BY bad, event_type
""")
def correlate_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused bodies and times between good messages: the good ones pair, no refused row is lost."""
    from pyspark.sql import functions as F
    apply_defaults(spark)
    inf = kserve_inferences(feeds.refused_pairs(spark, sf_dir))
    event_id = F.substring_index(F.col("_src.event_id"), "-", -1).cast("long")
    kinds = feeds.table(spark, sf_dir, "events", spread=False).select(F.col("event_id").alias("e"), "event_type")
    return (inf.select(F.coalesce("_reason", F.lit("paired")).alias("outcome"), event_id.alias("e")).join(kinds, "e")
            .groupBy("outcome", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("ids")))


@query("row_shapes_columns", f"""
SELECT CAST(doc_id AS VARCHAR) || '_' || p.i AS id, {_iso(f"(TIMESTAMP '{feeds.EMBED_TS}' + to_seconds(doc_id))")} AS occurred_at,
       CASE p.i WHEN 0 THEN source ELSE lang END AS source, n_chars + p.i AS chars,
       CASE p.i WHEN 0 THEN n_chars / 2 ELSE n_chars / 4 END AS half, CAST(NULL AS VARCHAR) AS reason
FROM documents, (VALUES (0), (1)) AS p(i) WHERE lang <> 'es'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 'unequal_column_lengths' FROM documents WHERE lang = 'es'
""")
def row_shapes_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dicts of columns are frames; unequal columns are refused."""
    from pyspark.sql import functions as F
    apply_defaults(spark)
    rows = datapoints(parse_json_events(feeds.column_events(spark, sf_dir))).rows
    ok = F.col("_reason").isNull()
    return rows.select(*[F.when(ok, F.col(c)).alias(c) for c in ("id", "occurred_at", "source", "chars", "half")], F.col("_reason").alias("reason"))


@query("stream_quarantine", f"""{_REFUSED}
SELECT bad AS reason, count(*) AS n FROM ev0 WHERE bad IS NOT NULL GROUP BY bad
UNION ALL SELECT 'logged' AS reason, count(*) AS n FROM fold WHERE emit
""")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 as a stream: refused messages next to the lake, good ones paired as in batch."""
    from pyspark.sql import functions as F
    base = _stream_run(spark, sf_dir, feeds.refused_pairs, quarantine=True)
    refused = _landed(spark, f"{base}/quarantine/messages").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    logged = _landed(spark, f"{base}/lake/kserve-stream").agg(F.count(F.lit(1)).alias("n")).select(F.lit("logged").alias("reason"), "n")
    return refused.unionByName(logged)


# --- plug-ins of the user: a processor on Arrow batches, a destination of our own ----------------

def _parse_lines(batch):
    """A user's event processor: lines of text to inferences, with NumPy; a line with too few parts raises."""
    import numpy as np
    import pyarrow as pa
    lines = [line.split("|") for line in batch.column("value").to_pylist()]
    ids, models, users, ks, values = (list(part) for part in zip(*lines, strict=True)) if lines else ([], [], [], [], [])
    value = np.array([float(v) if v else np.nan for v in values])
    k = np.array([float(x) if x else np.nan for x in ks])
    score = np.where(np.isnan(value) | np.isnan(k), None, 2 * value + np.nan_to_num(k))
    inputs = [[{"user_id": int(u) if u else None, "k": int(x) if x else None}] for u, x in zip(users, ks)]
    return pa.RecordBatch.from_pydict({
        "id": ids, "model_name": models, "model_version": [None] * len(ids), "occurred_at": pa.nulls(len(ids), pa.timestamp("us", "UTC")),
        "inputs": pa.array(inputs, pa.list_(pa.struct([("user_id", pa.int64()), ("k", pa.int64())]))),
        "outputs": pa.array([[{"score": s}] for s in score], pa.list_(pa.struct([("score", pa.float64())])))})


@query("user_processor", f"""
SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) || '_0' END AS id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN 2 * value + {_K} END AS score, CASE WHEN event_type = 'error' THEN 'processor_error' END AS reason
FROM events
""")
def user_processor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered processor on Arrow batches; the lines that it can't read are refused, the others of their batch are not."""
    from pyspark.sql import functions as F
    from predlake.plans.logger import arrow_processor, run_logger
    from predlake.plans.spec import LoggerSpec
    apply_defaults(spark)
    arrow_processor("lines", "array<struct<user_id: bigint, k: bigint>>", "array<struct<score: double>>")(_parse_lines)
    rows = run_logger(LoggerSpec.from_dict(_stream_spec("lines", "", "lines")), feeds.text_events(spark, sf_dir)).rows
    ok = F.col("_reason").isNull()
    return rows.select(F.when(ok, F.col("id")).alias("id"), F.when(ok, F.col("user_id")).alias("user_id"), F.when(ok, F.col("score")).alias("score"),
                       F.substring_index("_reason", ":", 1).alias("reason"))


@query("destination_files", ORACLES["json_flatten"])
def destination_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A destination by the Python Data Source API, in batch; read back by its manifests."""
    from predlake.plans.logger import run_logger, write_logger
    from predlake.plans.spec import LoggerSpec
    from predlake.sinks.files import read_committed
    from predlake.streaming.logger import scratch
    apply_defaults(spark)
    spec = _stream_spec("lined", scratch(spark, "files"), "json")
    spec["destination"] = {"type": "files", "config": spec["destination"]["config"]}
    logged = run_logger(LoggerSpec.from_dict(spec), feeds.json_events(spark, sf_dir))
    return read_committed(spark, write_logger(LoggerSpec.from_dict(spec), logged), logged.schema.struct_type())


@query("stream_files", ORACLES["json_flatten"])
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3 in a stream: each micro-batch is one manifest."""
    from predlake.operators.schema import lookup
    from predlake.sinks.files import read_committed
    spec = _stream_spec("lined", "", "json")
    spec["destination"] = {"type": "files", "config": spec["destination"]["config"]}
    base = _stream_run(spark, sf_dir, feeds.json_events, [spec], pinned=False)
    return read_committed(spark, f"{base}/lake/lined", lookup(spark, f"{base}/catalog", "lined-value").struct_type())


# --- many loggers by rules ---------------------------------------------------------------------

_RULES = """
rule AS (
  SELECT 's' || s_suppkey AS logger, CASE s_suppkey % 6 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup' WHEN 4 THEN 'error' END AS model_name,
         CASE s_suppkey % 4 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' END AS model_version, s_suppkey % 5 = 0 AS named FROM supplier)"""


@query("fan_out_rules", f"""
WITH {_RULES},
c AS (SELECT *, {_K} AS k, CASE WHEN {_K} % 3 = 0 THEN 'v2' ELSE 'v1' END AS version FROM ({_CORRELATED}))
SELECT logger, CAST(event_id AS VARCHAR) || '_0' AS id, {_iso('rts')} AS occurred_at, user_id AS user, named
FROM c JOIN rule ON (rule.model_name IS NULL OR rule.model_name = c.event_type) AND (rule.model_version IS NULL OR rule.model_version = c.version)
""")
def fan_out_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: as many loggers as there are suppliers, by a rule index: one scan, one join, one write by logger."""
    from pyspark.sql import functions as F
    from predlake.operators.routing import LOGGER, route, write_routed
    from predlake.streaming.logger import scratch
    apply_defaults(spark)
    s = F.col("s_suppkey")
    models, named = F.array(*[F.lit(m) for m in ("click", "view", "purchase", "signup", "error")]), s % 5 == 0
    rules = feeds.table(spark, sf_dir, "supplier", spread=False).select(
        F.concat(F.lit("s"), s.cast("string")).alias("logger"), F.get(models, (s % 6).cast("int")).alias("model_name"),
        F.when(s % 4 == 0, "v1").when(s % 4 == 1, "v2").alias("model_version"),
        F.when(named, F.array(F.lit("user"), F.lit("k"))).alias("input_names"), F.lit(None).cast("array<string>").alias("output_names"))
    path = write_routed(route(kserve_inferences(feeds.kserve_pairs(spark, sf_dir)), rules, gathered=True), scratch(spark, "routed"), gathered=True)
    rows = spark.read.schema("id string, occurred_at string, data string, logger string").parquet(path)
    rows = rows.select(LOGGER, "id", "occurred_at", F.from_json("data", "user string, X0 string").alias("d"))
    return rows.select(LOGGER, "id", "occurred_at", F.coalesce("d.user", "d.X0").cast("bigint").alias("user"), F.col("d.user").isNotNull().alias("named"))


# --- the lake: compaction and replay ----------------------------------------------------------

@query("lake_compact", ORACLES["json_flatten"])
def lake_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: micro-batches compacted between the runs of a stream; a snapshot has every row once."""
    from predlake.operators.schema import lookup
    from predlake.sinks.compact import compact, read_snapshot

    def schema(base):
        return lookup(spark, f"{base}/catalog", "json-stream-value").struct_type()

    def between(base):
        compact(spark, f"{base}/lake/json-stream", schema(base))
    base = _stream_run(spark, sf_dir, feeds.json_events, [_stream_spec("json-stream", "", "json")], pinned=False, between=between)
    return read_snapshot(spark, f"{base}/lake/json-stream", schema(base))


@query("quarantine_replay", f"{ORACLES['json_flatten']} WHERE event_type <> 'error'")
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: refused messages corrected by a rule and logged, each once; a second replay adds nothing."""
    from pyspark.sql import functions as F
    from predlake.operators.replay import replay
    from predlake.operators.schema import lookup
    from predlake.plans.spec import LoggerSpec
    spec = _stream_spec("mended", "", "json")
    base = _stream_run(spark, sf_dir, feeds.damaged_events, [spec], quarantine=True, pinned=False)
    logger = LoggerSpec.from_dict(spec)
    logger.destination.config["url"] = f"{base}/lake"
    rules = {"malformed_body": F.regexp_replace("value", r"\s*<<end of line>>$", "")}
    schema = lookup(spark, f"{base}/catalog", logger.subject)
    for _ in range(2):
        replay(spark, logger, f"{base}/quarantine/messages", f"{base}/ledger", rules, schema)
    return _landed(spark, f"{base}/lake/mended")
