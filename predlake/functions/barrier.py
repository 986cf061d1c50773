"""A filter-pushdown barrier for projections that parse payloads.

Catalyst pushes a ``where`` below a ``Project`` by substituting every column
reference with its defining expression. For a column such as ``_reason``
(a ``CASE`` over JSON parses, headers and frames) that inlines the parse once
per reference and evaluates it twice (filter and project). A ``Project``
holding a nondeterministic expression is never crossed by that rule, so a
``spark_partition_id()`` column (cheap, codegen'd) placed right after the
expensive projection keeps later filters above it. The column is internal
(``_nd``) and dropped by the final projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BARRIER = "_nd"


def barrier(df: DataFrame) -> DataFrame:
    return df.withColumn(BARRIER, F.spark_partition_id())


def where(df: DataFrame, cond) -> DataFrame:
    """``df.where(cond)`` that stays above the last barrier.

    Referencing the barrier column keeps it from being pruned, so the
    nondeterministic projection stays in the plan and the filter above it.
    """
    if BARRIER in df.columns:
        cond = cond & (F.col(BARRIER) >= 0)
    return df.where(cond)
