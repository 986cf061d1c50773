"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: must equal the event protocol's strings. -----------------
# CloudEvents binary-mode header names.
HEADER_ID = "ce_id"
HEADER_TYPE = "ce_type"
HEADER_TIME = "ce_time"
# KServe CloudEvent types.
REQUEST_TYPE = "org.kubeflow.serving.inference.request"
RESPONSE_TYPE = "org.kubeflow.serving.inference.response"
# KServe payload keys: V1 request/response, V2 request/response.
V1_REQUEST_KEY = "instances"
V1_RESPONSE_KEY = "predictions"
V2_REQUEST_KEY = "inputs"
V2_RESPONSE_KEY = "outputs"
# Prefixes of default names for positional input / output columns.
INPUT_PREFIX = "X"
OUTPUT_PREFIX = "Y"
# Pairing window and state expiry of the KServe correlation.
DEFAULT_WINDOW = "10 seconds"
DEFAULT_EXPIRY = "10 seconds"
# ---------------------------------------------------------------------------

RESERVED_COLUMNS = ("id", "occurred_at")

# One message of a topic: the Kafka source schema with includeHeaders=true.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]

# A parsed table of datapoints: ordered column names, rows of VARIANT cells and
# an error (NULL when the payload parsed).
FRAME_DDL = "struct<cols: array<string>, rows: array<array<variant>>, err: string>"

# Quarantine rows: why, and the envelope fields that locate the message.
QUARANTINE = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("value", T.StringType()),
])
QUARANTINE_COLUMNS = [f.name for f in QUARANTINE.fields]
