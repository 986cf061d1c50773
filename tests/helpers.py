"""Build one-message envelopes and read frames back as Python values."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from predlake.functions import frames as FR
from predlake.model import ENVELOPE, REQUEST_TYPE, RESPONSE_TYPE

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def frame_of(spark, payload, side="request"):
    """(cols, rows as Python values, err) of one request/response body."""
    text = payload if isinstance(payload, str) else json.dumps(payload)
    sql = FR.request_frame_sql if side == "request" else FR.response_frame_sql
    out = (spark.createDataFrame([(text,)], "value string").withColumn("b", F.expr(FR.parse_body("value")))
           .select(F.expr(sql("b", "value")).alias("f")).select(
               "f.cols", F.expr("transform(f.rows, r -> transform(r, c -> to_json(c)))").alias("rows"), "f.err").first())
    rows = None if out.rows is None else [[None if c is None else json.loads(c) for c in r] for r in out.rows]
    return out.cols, rows, out.err


def envelope(ce_id, kind, body, ts, offset, partition=0, ce_time=None, topic="t"):
    headers = []
    if ce_id is not None:
        headers.append(("ce_id", ce_id.encode()))
    if kind is not None:
        headers.append(("ce_type", {"R": REQUEST_TYPE, "S": RESPONSE_TYPE}.get(kind, kind).encode()))
    if ce_time is not None:
        headers.append(("ce_time", ce_time.encode()))
    value = body if (body is None or isinstance(body, str)) else json.dumps(body)
    return (None, value, [{"key": k, "value": bytearray(v)} for k, v in headers], topic, partition, offset, ts)


def envelopes_df(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def pair(spark, request, response, resp_id="r1", ce_id="e1", ts=T0):
    resp = dict(response)
    resp.setdefault("id", resp_id)
    return envelopes_df(spark, [
        envelope(ce_id, "R", request, ts, 0),
        envelope(ce_id, "S", resp, ts + dt.timedelta(milliseconds=5), 1, ce_time="2024-01-01T00:00:00Z"),
    ])
