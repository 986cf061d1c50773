"""Event processors written by the user, on Arrow batches.

The user's function gets a batch of envelopes and returns one row for each, in the
columns of PROCESSED: ``id``, ``model_name``, ``model_version``, ``occurred_at``, and
``inputs`` / ``outputs`` as lists of structs of a declared type. NumPy and pandas are at
hand in the batch. A batch that raises is taken again in parts, down to one row where
need be, so only the messages that raise alone are refused, with what was raised; they go to the
quarantine like any other.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from predlake.functions.barrier import barrier
from predlake.model import ENVELOPE

Processor = Callable[[pa.RecordBatch], pa.RecordBatch]
HEAD = "id string, model_name string, model_version string, occurred_at timestamp"
LOCATOR = ["topic", "partition", "offset", "timestamp"]

# Executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _guarded(fn: Processor, schema: T.StructType):
    """Batches of envelopes -> rows of the declared columns, the message's place, text and what was raised."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    made = [n for n in schema.names if n not in (*LOCATOR, "value", "_error")]

    types = [arrow.field(n).type for n in made]
    nothing = [pa.nulls(1, t) for t in types]

    def processed(batch: pa.RecordBatch) -> list[pa.Array]:
        """The made columns of a batch; raises where the function does or its result doesn't fit."""
        out = fn(batch)
        if out.num_rows != batch.num_rows:
            raise ValueError(f"{out.num_rows} rows for {batch.num_rows} messages")
        return [c if c.type == t else c.cast(t) for c, t in zip((out.column(n) for n in made), types)]

    def taken(batch: pa.RecordBatch) -> tuple[list[list[pa.Array]], list[str | None]]:
        """A batch in parts: one that raises is halved, the next after one that does not is twice as large."""
        parts, errors, at, size = [], [], 0, max(1, batch.num_rows // 2)
        while at < batch.num_rows:
            size = min(size, batch.num_rows - at)
            try:
                parts.append(processed(batch.slice(at, size)))
                errors += [None] * size
                at, size = at + size, 2 * size
            except Exception as e:
                if size > 1:
                    size //= 2
                    continue
                parts.append(nothing)
                errors.append(f"{type(e).__name__}: {e}")
                at += 1
        return parts, errors

    def run(batches):
        for batch in batches:
            try:
                parts, errors = [processed(batch)], [None] * batch.num_rows
            except Exception:
                parts, errors = taken(batch)
            columns = {n: pa.concat_arrays([p[i] for p in parts]) if parts else pa.nulls(0, types[i]) for i, n in enumerate(made)}
            columns |= {n: batch.column(n) for n in LOCATOR} | {"value": batch.column("value").cast(pa.string()), "_error": pa.array(errors, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[n].cast(arrow.field(n).type) for n in arrow.names], schema=arrow)
    return run


def _frame(side: str, rows_type: T.DataType) -> str:
    """A list of structs as a frame: the struct's fields are the columns."""
    if not (isinstance(rows_type, T.ArrayType) and isinstance(rows_type.elementType, T.StructType)):
        raise TypeError(f"{side} must be declared as a list of structs")
    names = rows_type.elementType.names
    text = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    cells = ", ".join(f"cast(r.`{n}` as variant)" for n in names)
    return (f"named_struct('cols', IF({side} IS NULL, cast(null as array<string>), array({text})), 'rows', transform({side}, r -> array({cells})), "
            f"'err', IF({side} IS NULL, 'missing_{side}', cast(null as string)))")


def arrow_inferences(envelopes: DataFrame, fn: Processor, inputs: str, outputs: str) -> DataFrame:
    """Envelopes -> inferences by ``fn``; ``inputs`` and ``outputs`` are the declared types (``array<struct<...>>``).

    A null ``occurred_at`` falls back to the message time. Reasons: ``processor_error: <what was raised>``,
    ``missing_id``, ``missing_inputs``, ``missing_outputs``. One batch or stream in, narrow, no shuffle.
    """
    locator = T.StructType([ENVELOPE[c] for c in LOCATOR])
    schema = T.StructType([*T.DataType.fromDDL(HEAD).fields, T.StructField("inputs", T.DataType.fromDDL(inputs)),
                           T.StructField("outputs", T.DataType.fromDDL(outputs)), *locator.fields, *T.DataType.fromDDL("value string, _error string").fields])
    out = barrier(envelopes.select(*ENVELOPE.names).mapInArrow(_guarded(fn, schema), schema))
    out = out.withColumn("inputs", F.expr(_frame("inputs", schema["inputs"].dataType))).withColumn("outputs", F.expr(_frame("outputs", schema["outputs"].dataType)))
    reason = (F.when(F.col("_error").isNotNull(), F.concat(F.lit("processor_error: "), F.col("_error"))).when(F.col("id").isNull(), F.lit("missing_id"))
              .when(F.col("inputs.err").isNotNull(), F.col("inputs.err")).when(F.col("outputs.err").isNotNull(), F.col("outputs.err")))
    src = F.struct(*LOCATOR, F.lit(None).cast("string").alias("event_id"), "value")
    return barrier(out.select("id", "model_name", "model_version", F.coalesce("occurred_at", "timestamp").alias("occurred_at"),
                              "inputs", "outputs", reason.alias("_reason"), src.alias("_src")))
