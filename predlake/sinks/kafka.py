"""K1: the target-topic sink (one JSON value per logged row), in batch and for each micro-batch of a stream.

Needs the Kafka connector at deploy time; without it the destination raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def to_messages(rows: DataFrame, key: str = "id") -> DataFrame:
    """``key`` / ``value`` columns: the row id and the whole row as JSON."""
    return rows.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("value"))
