"""ISO-8601 parsing and formatting as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_iso(col: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP (NULL when unparseable, or without a date).

    Extended forms (``2024-01-01T00:00:07.5Z``, offsets, date only) go through
    the standard cast; the basic form ``20220301T101112Z`` gets its own pattern.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(
        F.when(c.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"), c.try_cast("timestamp")),
        F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmssX")),
        F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss.SSSSSSX")),
    )


def format_iso(col: Column | str) -> Column:
    """TIMESTAMP -> ISO-8601 text in UTC, like Python's ``isoformat()``.

    Whole seconds print without a fraction, otherwise six fraction digits.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("timestamp")
    return (F.when(c.isNull(), F.lit(None))
            .when(F.unix_micros(c) % 1_000_000 == 0,
                  F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx"))
            .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")))
