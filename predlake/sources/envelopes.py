"""Envelope sources (files in batch or stream, a Kafka topic).

A file of envelopes and a Kafka topic share one schema (the Kafka source
schema with headers), so every operator downstream is source-agnostic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from predlake.model import ENVELOPE


def read_envelopes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of landed envelopes."""
    return spark.read.schema(ENVELOPE).format(fmt).load(path)


def stream_envelopes(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a folder of envelope files."""
    r = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_available(spark: SparkSession) -> bool:
    """Whether the Kafka connector is on the classpath (it is a deploy-time package)."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def stream_topic(spark: SparkSession, bootstrap: str, topic: str, **options: str) -> DataFrame:
    """S1 from Kafka: ``subscribe`` + ``includeHeaders``; value decoded later (S3).

    Extra options (``kafka.security.protocol``, ``kafka.ssl.*``, offsets) pass through.
    """
    if not kafka_available(spark):
        raise RuntimeError("the Kafka connector package is not on the classpath")
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("includeHeaders", "true"))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def time_slices(envelopes: DataFrame, slices: int) -> DataFrame:
    """Adds ``slice``: equal parts of the time between the first and the last message, numbered from 0."""
    lo, hi = envelopes.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    span = max((hi or 0) - (lo or 0), 0) + 1
    return envelopes.withColumn("slice", F.least(
        F.floor((F.unix_micros("timestamp") - F.lit(lo)) * slices / F.lit(span)), F.lit(slices - 1)).cast("int"))


def stage_slices(envelopes: DataFrame, path: str, slices: int) -> None:
    """Write envelopes under ``path``, one folder per time slice, with as many files as there are tasks."""
    time_slices(envelopes, slices).write.partitionBy("slice").parquet(path)


def deliver_slice(spark: SparkSession, staged: str, slice_no: int, landing: str) -> None:
    """Append one staged slice to the folder that a stream reads.

    What has been delivered before a run decides the replay order, so it holds on any file system.
    """
    (spark.read.schema(ENVELOPE).parquet(f"{staged}/slice={slice_no}").write.mode("append").parquet(landing))
