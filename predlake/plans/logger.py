"""Build a logger's dataflow from its spec.

``envelopes -> inferences -> filters -> names -> schema -> datapoints``; each
arrow is one operator module. Event processors, schema providers and
destinations are looked up by ``type`` in small registries (U1-U3), so a user
plugs in their own ``DataFrame -> DataFrame`` function.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from predlake.operators import quarantine as Q
from predlake.operators.filters import filter_spec
from predlake.operators.rows import name_columns, zip_rows
from predlake.operators.schema import PinnedSchema, align, enforce, evolve, resolve
from predlake.plans.spec import LoggerSpec, SpecError
from predlake.session import kept

# --- U1-U3: registries --------------------------------------------------------

EventProcessor = Callable[[DataFrame, dict], DataFrame]
DestinationFn = Callable[[DataFrame, dict, str], Any]

EVENT_PROCESSORS: dict[str, EventProcessor] = {}
STREAM_PROCESSORS: dict[str, EventProcessor] = {}
SCHEMA_PROVIDERS: dict[str, Callable[..., PinnedSchema]] = {}
DESTINATIONS: dict[str, DestinationFn] = {}


def event_processor(name: str):
    """Register ``fn(envelopes, config) -> inferences``."""
    def deco(fn):
        EVENT_PROCESSORS[name] = fn
        return fn
    return deco


def schema_provider(name: str):
    """Register ``fn(named_inferences, config, subject, catalog) -> PinnedSchema``."""
    def deco(fn):
        SCHEMA_PROVIDERS[name] = fn
        return fn
    return deco


def destination(name: str):
    """Register ``fn(rows, config, logger_name) -> writer result``."""
    def deco(fn):
        DESTINATIONS[name] = fn
        return fn
    return deco


def stream_processor(name: str):
    """U1 for streams: register ``fn(streaming envelopes, config) -> inferences``, refused messages among them."""
    def deco(fn):
        STREAM_PROCESSORS[name] = fn
        return fn
    return deco


def arrow_processor(name: str, inputs: str, outputs: str):
    """U1 for batches and streams: register ``fn(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` with the declared
    types of its ``inputs`` and ``outputs`` columns (see :mod:`predlake.operators.user_arrow`)."""
    from predlake.operators.user_arrow import arrow_inferences

    def deco(fn):
        def processor(envelopes: DataFrame, config: dict) -> DataFrame:
            return arrow_inferences(envelopes, fn, inputs, outputs)
        event_processor(name)(processor)
        stream_processor(name)(processor)
        return fn
    return deco


def resolve_type(registry: dict, kind: str, name: str):
    """A registered plug-in by its name in the spec; unknown names are refused."""
    if name not in registry:
        raise SpecError(f"unknown {kind} type {name!r}")
    return registry[name]


@stream_processor("json")
@event_processor("json")
def _json_processor(envelopes: DataFrame, config: dict) -> DataFrame:
    from predlake.operators.json_events import parse_json_events
    return parse_json_events(envelopes)


@event_processor("kserve")
def _kserve_processor(envelopes: DataFrame, config: dict) -> DataFrame:
    from predlake.operators.correlate import kserve_inferences
    from predlake.operators.hot_keys import HOT_ROWS
    return kserve_inferences(envelopes, window=config.get("window", "10 seconds"), hot_rows=config.get("hotRows", HOT_ROWS),
                             with_rejects=config.get("refused", True), model_name=config.get("modelName"), model_version=config.get("modelVersion"))


@stream_processor("kserve")
def _kserve_stream(envelopes: DataFrame, config: dict) -> DataFrame:
    from predlake.streaming.correlate import TIME_BUCKET, stream_inferences, stream_pairs
    window = config.get("window", "10 seconds")
    return stream_inferences(stream_pairs(envelopes, window, config.get("expires", window), config.get("stateBuckets"),
                                          config.get("stateTime", TIME_BUCKET)))


@destination("parquet")
@destination("confluent-s3")
def _parquet_destination(rows: DataFrame, config: dict, logger_name: str):
    """K2: batch write under ``<url>/<logger>`` (streams use sinks.parquet.write_stream)."""
    from predlake.sinks import parquet
    return parquet.write_batch(rows, config, logger_name)


@destination("files")
def _files_destination(rows: DataFrame, config: dict, logger_name: str):
    """JSON lines through our own data source: all files of a batch or none, exactly once by batch id."""
    from predlake.sinks import files
    return files.write_batch(rows, config, logger_name)


@destination("kafka")
def _kafka_destination(rows: DataFrame, config: dict, logger_name: str):
    """K1: one JSON message per row to the logger's target topic (batch)."""
    from predlake.sinks.kafka import to_messages
    from predlake.sources.envelopes import kafka_available
    if not kafka_available(rows.sparkSession):
        raise RuntimeError("the Kafka connector package is not on the classpath")
    (to_messages(rows).write.format("kafka")
     .option("kafka.bootstrap.servers", config["bootstrapServers"])
     .option("topic", config.get("topic", logger_name)).save())


@schema_provider("avro")
@schema_provider("inferred")
def _inferred_schema(named: DataFrame, config: dict, subject: str | None,
                     catalog: str | None) -> PinnedSchema:
    return resolve(named, catalog, subject)


READ_ONCE = {"parquet", "confluent-s3", "files", "kafka"}   # destinations that read their rows once; a user's own may not
USABLE_ONLY = {"avro", "inferred", "evolving"}   # schema providers that read no refused message; a user's own may
EACH_BATCH = {"evolving"}   # schema providers that a stream asks again in every micro-batch


@schema_provider("evolving")
def _evolving_schema(named: DataFrame, config: dict, subject: str | None, catalog: str | None) -> PinnedSchema:
    """C2 / C4 with versions: columns may come and integers may widen; every row says which version it has."""
    if not (catalog and subject):
        raise SpecError("an evolving schema needs a catalog")
    return evolve(named, catalog, subject)


# --- datapoints ---------------------------------------------------------------

@dataclass
class Logged:
    """A logger's result: typed datapoints (with ``_reason`` / ``_src``) and schema.

    ``cached`` is the persisted inference frame the rows are read from when the
    schema had to be inferred first; :meth:`release` drops it once the rows
    have been written.
    """

    rows: DataFrame
    schema: PinnedSchema
    cached: DataFrame | None = None

    def release(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()
            self.cached = None

    @property
    def good(self) -> DataFrame:
        return Q.good(self.rows)

    @property
    def quarantine(self) -> DataFrame:
        return Q.to_quarantine(self.rows)


def datapoints(inferences: DataFrame,
               input_names: Sequence[str] | None = None,
               output_names: Sequence[str] | None = None,
               schema: PinnedSchema | None = None,
               strict: bool = False,
               catalog: str | None = None,
               subject: str | None = None) -> Logged:
    """P9-P12 + C1-C4: inferences -> one typed row per datapoint.

    Without a pinned schema, the schema is inferred first (one aggregate) and
    the rows are then read from the same named inferences. Batch inputs are
    persisted (memory, spilling to disk; lost blocks are recomputed from the
    lineage) so the parse and the pairing shuffle run once, not twice.
    """
    named = name_columns(inferences, input_names, output_names)
    cached = None
    if schema is None:
        pinned = None
        if catalog and subject:
            from predlake.operators.schema import lookup
            pinned = lookup(named.sparkSession, catalog, subject)
        if pinned is None:
            if not named.isStreaming and not inferences.is_cached:
                cached = named = kept(named)
            pinned = resolve(named, catalog, subject)
    else:
        pinned = schema
    rows = zip_rows(align(named, pinned), strict=strict)
    return Logged(enforce(rows, pinned), pinned, cached)


def run_logger(spec: LoggerSpec, envelopes: DataFrame, catalog: str | None = None,
               schema: PinnedSchema | None = None,
               inferences: DataFrame | None = None) -> Logged:
    """M2: one logger, batch or stream input (schema must be given for streams).

    ``inferences`` lets several loggers share one parsed + correlated frame.
    """
    own = inferences is None
    if own:
        # a processor may leave out early what the logger's own filter drops
        inferences = resolve_type(EVENT_PROCESSORS, "events", spec.events.type)(envelopes, {**spec.events.config, **(spec.filters or {})})
    inferences = filter_spec(inferences, spec.filters)
    names = spec.column_names()
    if schema is None:
        provider = resolve_type(SCHEMA_PROVIDERS, "schema", spec.schema.type if spec.schema else "avro")
        cached = None
        if own and not inferences.isStreaming:
            cached = inferences = kept(inferences)   # the provider reads them before the rows do
        named = name_columns(inferences, names["inputs"], names["outputs"])
        schema = provider(named, spec.schema.config if spec.schema else {}, spec.subject, catalog)
        logged = datapoints(inferences, names["inputs"], names["outputs"], schema=schema)
        logged.cached = cached
        return logged
    return datapoints(inferences, names["inputs"], names["outputs"], schema=schema)


@dataclass
class FannedOut:
    """The rows of all loggers; :meth:`release` drops what they share once they have been written."""

    rows: DataFrame
    shared: list[DataFrame]

    def release(self) -> None:
        while self.shared:
            self.shared.pop().unpersist()


def fan_out(specs: Sequence[LoggerSpec], envelopes: DataFrame,
            catalog: str | None = None) -> FannedOut:
    """M1: several loggers on one feed -> one frame with a ``logger`` column.

    Envelopes are parsed and correlated once per events type; every logger
    filters, names and types that shared frame (the shared shuffle is reused
    across the union's branches). Each logger's typed columns are packed as
    JSON in ``data`` since the loggers' schemas differ.
    """
    shared: dict[tuple[str, str], DataFrame] = {}
    out = None
    for spec in specs:
        key = (spec.events.type, json.dumps(spec.events.config, sort_keys=True, default=str))
        if key not in shared:
            proc = resolve_type(EVENT_PROCESSORS, "events", spec.events.type)
            # parsed and paired once for all loggers on this feed
            shared[key] = kept(proc(envelopes, spec.events.config))
        logged = run_logger(spec, envelopes, catalog, inferences=shared[key])
        g = logged.good
        packed = g.select(F.lit(spec.name).alias("logger"), "id", "occurred_at",
                          F.to_json(F.struct(*[F.col(f"`{c}`") for c in g.columns
                                               if c not in ("id", "occurred_at")])).alias("data"))
        out = packed if out is None else out.unionByName(packed)
    return FannedOut(out, list(shared.values()))


def write_logger(spec: LoggerSpec, logged: Logged, quarantine_url: str | None = None):
    """U3 + Q1: write the good rows through the spec's destination and, when
    ``quarantine_url`` is given, the refused rows next to them; then release
    the persisted inferences."""
    fn = resolve_type(DESTINATIONS, "destination", spec.destination.type)
    try:
        out = fn(logged.good, spec.destination.config, spec.name)
        if quarantine_url:
            from predlake.sinks import parquet
            parquet.write_batch(logged.quarantine, {"url": quarantine_url}, spec.name)
        return out
    finally:
        logged.release()
