"""Inferences -> one row per datapoint.

Works on frames (ordered names + VARIANT cells) so that naming, zipping and
exploding are plain Catalyst expressions. Typing happens in
:mod:`predlake.operators.schema`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from predlake.model import INPUT_PREFIX, OUTPUT_PREFIX, RESERVED_COLUMNS


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names_sql(frame: str, prefix: str, override: Sequence[str] | None) -> str:
    """P9 / P10 on one frame column; returns the renamed frame (err on mismatch)."""
    if override is not None:
        names = "array(" + ", ".join(_sql_str(n) for n in override) + ")"
        return (f"IF({frame}.err IS NOT NULL OR size({frame}.cols) = {len(override)}, "
                f"named_struct('cols', IF({frame}.err IS NULL, {names}, {frame}.cols), "
                f"'rows', {frame}.rows, 'err', {frame}.err), "
                f"named_struct('cols', {frame}.cols, 'rows', {frame}.rows, "
                f"'err', 'column_count_mismatch'))")
    # Names exactly '0'..'n-1' (a RangeIndex, or such text keys) become X0.. / Y0..
    # (most tables' first name tells that they are not).
    is_positional = f"get({frame}.cols, 0) = '0' AND forall(transform({frame}.cols, (c, i) -> c = cast(i as string)), ok -> ok)"
    renamed = f"transform({frame}.cols, (c, i) -> concat('{prefix}', cast(i as string)))"
    return (f"named_struct('cols', IF({frame}.err IS NULL AND {is_positional}, {renamed}, {frame}.cols), "
            f"'rows', {frame}.rows, 'err', {frame}.err)")


def name_columns(inferences: DataFrame,
                 input_names: Sequence[str] | None = None,
                 output_names: Sequence[str] | None = None) -> DataFrame:
    """P9 default names and P10 overrides; reserved names become a reason."""
    df = (inferences
          .withColumn("inputs", F.expr(_names_sql("inputs", INPUT_PREFIX, input_names)))
          .withColumn("outputs", F.expr(_names_sql("outputs", OUTPUT_PREFIX, output_names))))
    reserved = "array(" + ", ".join(_sql_str(r) for r in RESERVED_COLUMNS) + ")"
    bad = (F.when(F.col("inputs.err").isNotNull(), F.col("inputs.err"))
           .when(F.col("outputs.err").isNotNull(), F.col("outputs.err"))
           .when(F.expr(f"arrays_overlap(transform(concat(inputs.cols, outputs.cols), c -> lower(c)), {reserved})"),
                 F.lit("reserved_column_name"))
           # A table's columns can't differ by case only
           .when(F.expr("array_join(concat(inputs.cols, outputs.cols), '') <> lower(array_join(concat(inputs.cols, outputs.cols), '')) AND "
                        "size(array_distinct(concat(inputs.cols, outputs.cols))) <> "
                        "size(array_distinct(transform(concat(inputs.cols, outputs.cols), c -> lower(c))))"),
                 F.lit("names_differ_by_case")))
    if "_reason" in df.columns:
        return df.withColumn("_reason", F.coalesce(F.col("_reason"), bad))
    return df.withColumn("_reason", bad)


def zip_rows(inferences: DataFrame, strict: bool = False) -> DataFrame:
    """J2 + P11: i-th input row with i-th output row, one output row each.

    Truncates to the shorter side like ``zip`` (``arrays_zip`` would pad with
    NULL instead). ``strict`` turns unequal row counts into a reason (B9).
    Adds ``pos``, ``in_row`` and ``out_row``; rows with a reason pass through
    once with NULL cells so the caller can quarantine them.
    """
    df = inferences
    if strict:
        df = df.withColumn("_reason", F.coalesce(
            F.col("_reason"),
            F.when(F.size("inputs.rows") != F.size("outputs.rows"), F.lit("row_count_mismatch"))))
    n = "least(size(inputs.rows), size(outputs.rows))"
    pairs = (f"IF(_reason IS NULL, zip_with(slice(inputs.rows, 1, {n}), slice(outputs.rows, 1, {n}), "
             f"(a, b) -> named_struct('in_row', a, 'out_row', b)), "
             f"array(named_struct('in_row', cast(null as array<variant>), "
             f"'out_row', cast(null as array<variant>))))")
    return df.select("*", F.posexplode(F.expr(pairs)).alias("pos", "_pair")) \
             .select("*", "_pair.in_row", "_pair.out_row").drop("_pair")
