"""A logger as a Structured Streaming query (S1 -> J1 -> P* -> C4 -> K2).

The stateless operators are the batch ones; only the pairing is a stateful
operator (:mod:`predlake.streaming.correlate`). A logger's schema is given, found
in the catalog (C3), or pinned inside the stream: the first micro-batch with a usable
inference is what it is inferred from (C1), and it is registered if no other starter
was first (C2). A restart finds it there. An ``evolving`` schema is asked for again in
every micro-batch.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from predlake.functions.barrier import where
from predlake.operators import quarantine as Q
from predlake.operators.filters import filter_spec as apply_filters
from predlake.operators.rows import name_columns
from predlake.operators.schema import PinnedSchema, lookup
from predlake.plans.logger import (
    DESTINATIONS, EACH_BATCH, EVENT_PROCESSORS, READ_ONCE, SCHEMA_PROVIDERS, STREAM_PROCESSORS, USABLE_ONLY, datapoints, resolve_type,
)
from predlake.plans.spec import LoggerSpec, SpecError
from predlake.session import scratch_folder
from predlake.sinks.parquet import DEFAULT_TRIGGER
from predlake.sources.envelopes import read_envelopes, stream_envelopes, stream_topic
from predlake.streaming.correlate import EXPIRED


scratch = scratch_folder


def check_types(spec: LoggerSpec) -> None:
    """Every type that a spec names must be registered; a stream needs a stream processor."""
    resolve_type(STREAM_PROCESSORS, "events", spec.events.type)
    resolve_type(SCHEMA_PROVIDERS, "schema", spec.schema.type if spec.schema else "avro")
    resolve_type(DESTINATIONS, "destination", spec.destination.type)


def pin_schema(spark: SparkSession, spec: LoggerSpec, landed: str,
               catalog: str | None = None) -> PinnedSchema:
    """C3, else C1 over landed envelopes (batch) + C2, by the spec's schema provider (U2), before a stream starts."""
    check_types(spec)
    inf = _landed_inferences(spark, [spec], landed)
    return _provided(spec, apply_filters(inf, spec.filters), catalog)


def pin_schemas(spark: SparkSession, specs: list[LoggerSpec], landed: str, catalog: str | None = None) -> dict[str, PinnedSchema]:
    """``pin_schema`` for the loggers of one stream: the landed envelopes are parsed and paired once for all of them."""
    if len(specs) < 2 or any(s.events != specs[0].events for s in specs):
        return {s.name: pin_schema(spark, s, landed, catalog) for s in specs}
    for s in specs:
        check_types(s)
    inf = _landed_inferences(spark, specs, landed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {s.name: _provided(s, apply_filters(inf, s.filters), catalog) for s in specs}
    finally:
        inf.unpersist()


def _landed_inferences(spark: SparkSession, specs: list[LoggerSpec], landed: str) -> DataFrame:
    """The landed envelopes as inferences; refused messages are not exchanged with the others where no provider reads them."""
    events = specs[0].events
    usable = all((s.schema.type if s.schema else "avro") in USABLE_ONLY for s in specs)
    return EVENT_PROCESSORS[events.type](read_envelopes(spark, landed), {**events.config, "refused": False} if usable else events.config)


def _provided(spec: LoggerSpec, kept: DataFrame, catalog: str | None) -> PinnedSchema:
    names = spec.column_names()
    named = name_columns(kept, names["inputs"], names["outputs"])
    provider = SCHEMA_PROVIDERS[spec.schema.type if spec.schema else "avro"]
    return provider(named, spec.schema.config if spec.schema else {}, spec.subject, catalog)


def source_of(spark: SparkSession, spec: LoggerSpec) -> DataFrame:
    """The stream that a spec's events come from: its topic where ``bootstrapServers`` is set (``options`` pass
    through, such as ``maxOffsetsPerTrigger``), or the envelope files under ``path`` (``maxFilesPerTrigger`` at a time)."""
    config = spec.events.config
    if "bootstrapServers" in config:
        return stream_topic(spark, config["bootstrapServers"], spec.topic, **{k: str(v) for k, v in (config.get("options") or {}).items()})
    if "path" in config:
        return stream_envelopes(spark, config["path"], max_files_per_trigger=config.get("maxFilesPerTrigger"))
    raise SpecError("events need 'bootstrapServers' or a 'path'")


class SchemaPins:
    """The schemas of a stream's loggers: given ones, and those pinned as micro-batches come."""

    def __init__(self, schemas: dict[str, PinnedSchema] | None, catalog: str | None) -> None:
        self.pinned = dict(schemas or {})
        self.catalog = catalog

    def known(self, spark: SparkSession, spec: LoggerSpec) -> PinnedSchema | None:
        """The schema that a logger has before a micro-batch is read: given, pinned or registered."""
        if spec.schema and spec.schema.type in EACH_BATCH:
            return None
        if spec.name not in self.pinned and self.catalog:
            found = lookup(spark, self.catalog, spec.subject)
            if found is not None:
                self.pinned[spec.name] = found
        return self.pinned.get(spec.name)

    def of(self, spec: LoggerSpec, kept: DataFrame) -> PinnedSchema | None:
        """The schema for a micro-batch's inferences ``kept``; None while no usable one has been seen."""
        found = self.known(kept.sparkSession, spec)
        if found is not None:
            return found
        names = spec.column_names()
        usable = where(name_columns(kept, names["inputs"], names["outputs"]), F.col("_reason").isNull())
        if usable.limit(1).count():
            self.pinned[spec.name] = _provided(spec, kept, self.catalog)
        return self.pinned.get(spec.name)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_conf(spark: SparkSession, state_partitions: int | None = None) -> dict[str, str | None]:
    """Settings a stateful logger stream needs at start (returns the old values).

    ``transformWithState`` requires the RocksDB state store; the number of
    state partitions is fixed by the first run of a checkpoint, so it is set
    here rather than inherited from a batch-sized default. Entries are not counted
    as they are written: for that RocksDB would read each key first.
    """
    want = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
    if state_partitions:
        want["spark.sql.shuffle.partitions"] = str(state_partitions)
    old = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    return old


def restore_conf(spark: SparkSession, old: dict[str, str | None]) -> None:
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def run_loggers(specs: list[LoggerSpec], envelopes: DataFrame, schemas: dict[str, PinnedSchema] | None, checkpoint: str,
                state_partitions: int | None = None, quarantine_url: str | None = None, available_now: bool = True,
                catalog: str | None = None):
    """M1 as a stream: all loggers of one topic on one stateful pass.

    Each micro-batch of inferences is kept while every logger filters, types and
    writes its rows through its destination (U3), under a folder named by the
    batch id that a repeated batch overwrites, so a restart neither loses nor
    repeats rows. A batch that is read once only (one logger whose schema is known, without quarantine) goes
    to its destination as it is made. Refused rows go next to them under ``quarantine_url`` (Q1):
    ``messages`` (refused by the parse), ``expired`` (late, or unpaired when their
    window ended) and one folder for each logger's typing. A logger without a schema in
    ``schemas`` gets one by ``SchemaPins`` with ``catalog``. ``state_partitions`` (the
    session's shuffle partitions where not given) is fixed by the first run of a checkpoint.
    """
    if any(s.events != specs[0].events for s in specs):
        raise SpecError("loggers of one stream share their events type and its settings")
    for spec in specs:
        check_types(spec)
    spark = envelopes.sparkSession
    pins = SchemaPins(schemas, catalog)

    def write(batch: DataFrame, batch_id: int) -> None:
        once = (len(specs) == 1 and not quarantine_url and specs[0].destination.type in READ_ONCE
                and pins.known(spark, specs[0]) is not None)
        if not once:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if quarantine_url:
                expired = F.col("reason") == EXPIRED
                refused = Q.to_quarantine(batch)
                _write_batch(refused.where(~expired), f"{quarantine_url}/messages", batch_id)
                _write_batch(refused.where(expired), f"{quarantine_url}/expired", batch_id)
            parsed = where(batch, F.col("_reason").isNull())
            for spec in specs:
                kept = apply_filters(parsed, spec.filters)
                schema = pins.of(spec, kept)
                if schema is None and not quarantine_url:
                    continue
                names = spec.column_names()
                # without a schema there is no usable row: all that is left has a reason
                logged = datapoints(kept, names["inputs"], names["outputs"], schema=schema or PinnedSchema())
                if schema is not None:
                    config = {**spec.destination.config, "batch": batch_id}
                    if spec.schema and spec.schema.type in EACH_BATCH:
                        config["version"] = schema.version
                    DESTINATIONS[spec.destination.type](logged.good, config, spec.name)
                if quarantine_url:
                    _write_batch(logged.quarantine, f"{quarantine_url}/{spec.name}", batch_id)
        finally:
            if not once:
                batch.unpersist()

    old = stream_conf(spark, state_partitions)
    try:
        inferences = STREAM_PROCESSORS[specs[0].events.type](envelopes, specs[0].events.config)
        writer = (inferences.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                  .outputMode("append").queryName(f"loggers-{specs[0].topic}-{uuid.uuid4().hex[:8]}"))
        wait = specs[0].destination.config.get("trigger", DEFAULT_TRIGGER)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=wait)).start()
    finally:
        restore_conf(spark, old)


def _write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
