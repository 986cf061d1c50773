"""Q1: split a frame with a ``_reason`` column into good rows and quarantine rows.

Quarantine rows keep the message locator (``_src`` struct, or the envelope
columns themselves) so a bad record can be found and replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from predlake.functions.barrier import BARRIER, where
from predlake.model import QUARANTINE, QUARANTINE_COLUMNS

REASON = "_reason"
SOURCE = "_src"


def to_quarantine(df: DataFrame) -> DataFrame:
    """Rows with a reason, projected to the quarantine schema."""
    q = where(df, F.col(REASON).isNotNull())
    src_fields = set()
    if SOURCE in q.columns:
        src_fields = set(q.schema[SOURCE].dataType.fieldNames())
    cols = []
    for c in QUARANTINE_COLUMNS:
        if c == "reason":
            cols.append(F.col(REASON).alias("reason"))
        elif c in src_fields:
            cols.append(F.col(f"{SOURCE}.{c}").alias(c))
        elif c in q.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).alias(c))

    return q.select(*[col.cast(f.dataType) for col, f in zip(cols, QUARANTINE.fields)])


def good(df: DataFrame) -> DataFrame:
    """Rows without a reason, internal columns dropped."""
    out = where(df, F.col(REASON).isNull()).drop(REASON)
    return out.drop(*[c for c in (SOURCE, BARRIER) if c in out.columns])
