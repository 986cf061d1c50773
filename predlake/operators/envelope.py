"""Decode envelopes and give every bad one a reason.

``classify`` adds the CloudEvent header fields and a ``_reason`` column
(NULL = usable). Nothing is dropped here; :mod:`predlake.operators.quarantine`
splits on ``reason`` so that silent drops of a plain stream processor become a
quarantine table (Q1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from predlake.functions.barrier import barrier
from predlake.functions.frames import parse_body, request_frame_sql, response_frame_sql
from predlake.functions.headers import header
from predlake.functions.times import parse_iso
from predlake.model import HEADER_ID, HEADER_TIME, HEADER_TYPE, REQUEST_TYPE, RESPONSE_TYPE


def decode(envelopes: DataFrame) -> DataFrame:
    """S2 + S3: header fields and the body as text (Kafka gives BINARY)."""
    value = F.col("value").cast("string")
    return (envelopes
            .withColumn("value", value)
            .withColumn("event_id", header(HEADER_ID))
            .withColumn("event_type", header(HEADER_TYPE))
            .withColumn("event_time", header(HEADER_TIME)))


def _kind() -> Column:
    return (F.when(F.col("event_type") == REQUEST_TYPE, F.lit("R"))
            .when(F.col("event_type") == RESPONSE_TYPE, F.lit("S")))


def classify(envelopes: DataFrame) -> DataFrame:
    """F1-F4, P2-P8 per message: a message either leaves as a usable event or with a ``_reason``.

    Every refusal is decided here, before the pairing, so a bad message never
    takes the place of a good one. The body is parsed once into ``body``; adds
    ``kind`` R/S, ``resp_id``, ``model_name``, ``model_version``, ``occurred_at``
    (responses) and ``frame``.
    """
    df = decode(envelopes).withColumn("kind", _kind())
    readable = F.col("kind").isNotNull() & F.col("value").isNotNull()
    df = df.withColumn("body", F.when(readable, F.expr(parse_body("value"))))
    is_resp = F.col("kind") == "S"
    df = (df.withColumn("frame", F.when(F.col("kind") == "R", F.expr(request_frame_sql("body", "value")))
                        .when(is_resp, F.expr(response_frame_sql("body", "value"))))
          .withColumn("occurred_at", F.when(is_resp, parse_iso("event_time"))))
    reason = (
        F.when(F.coalesce(F.col("event_id"), F.lit("")) == "", F.lit("missing_event_id"))   # F1
        .when(F.col("value").isNull(), F.lit("null_body"))                                   # F2
        .when(F.col("event_type").isNull(), F.lit("missing_event_type"))                     # B2
        .when(F.col("kind").isNull(), F.lit("unknown_event_type"))                           # F3
        .when(F.col("timestamp").isNull(), F.lit("missing_timestamp"))                       # W1: in no window
        .when(F.col("body").isNull(), F.lit("malformed_body"))
        .when(is_resp & F.col("body.id").isNull(), F.lit("response_without_id"))             # F4
        .when(F.col("frame.err").isNotNull(), F.col("frame.err"))                            # P2-P7
        .when(is_resp & F.col("event_time").isNull(), F.lit("missing_event_time"))           # P8, B2
        .when(is_resp & F.col("occurred_at").isNull(), F.lit("bad_event_time")))             # P8
    return barrier(df.withColumn("_reason", reason)
                   .withColumn("resp_id", F.when(is_resp, F.expr("try_variant_get(body.id, '$', 'string')")))
                   .withColumn("model_name", F.col("body.model_name"))
                   .withColumn("model_version", F.col("body.model_version"))
                   .drop("body"))
