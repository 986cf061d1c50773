"""JSON inference events -> inferences (stateless, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from predlake.functions.barrier import barrier
from predlake.functions.frames import RECORDS_DDL, body_of, records_frame_sql, whole_body
from predlake.functions.times import parse_iso


def parse_json_events(events: DataFrame, value: str = "value",
                      fallback_time: str = "timestamp") -> DataFrame:
    """One JSON object per message -> inference columns.

    ``{id, model_name, model_version, inputs, outputs, occurred_at}``, all
    optional. ``inputs`` / ``outputs`` are lists of dicts or of lists, or a
    dict of columns. A body must be exactly one JSON object: truncated text,
    lists, NaN and text after the object are ``malformed_body``.
    ``occurred_at`` falls back to the envelope timestamp (deterministic, UTC)
    rather than the wall clock. Missing parts are reasons, not exceptions.
    """
    text = f"cast({value} as string)"
    payload = f"inputs: {RECORDS_DDL}, outputs: {RECORDS_DDL}"
    df = events.withColumn("_w", F.expr(whole_body(text, payload))).withColumn("_h", F.expr(body_of("_w", text)))
    df = (df
          .withColumn("id", F.expr("try_variant_get(_h.id, '$', 'string')"))
          .withColumn("model_name", F.col("_h.model_name"))
          .withColumn("model_version", F.col("_h.model_version"))
          .withColumn("_t_txt", F.col("_h.occurred_at"))
          .withColumn("_t", parse_iso("_t_txt"))
          .withColumn("occurred_at", F.coalesce(F.col("_t"), F.col(fallback_time)))
          .withColumn("inputs", F.expr(records_frame_sql("_h.inputs", text, "inputs")))
          .withColumn("outputs", F.expr(records_frame_sql("_h.outputs", text, "outputs"))))
    reason = (F.when(F.col(value).isNull(), F.lit("null_body"))
              .when(F.col("_h").isNull(), F.lit("malformed_body"))
              .when(F.col("inputs.err").isNotNull(), F.col("inputs.err"))
              .when(F.col("outputs.err").isNotNull(), F.col("outputs.err"))
              .when(F.col("_t_txt").isNotNull() & F.col("_t").isNull(), F.lit("bad_occurred_at"))
              .when(F.col("id").isNull(), F.lit("missing_id")))            # B13
    src = F.struct(*[F.col(c) if c in events.columns else F.lit(None).alias(c)
                     for c in ("topic", "partition", "offset", "timestamp", "event_id")],
                   F.col(value).cast("string").alias("value"))
    return barrier(df.withColumn("_reason", reason).withColumn("_src", src)
                   .select("id", "model_name", "model_version", "occurred_at", "inputs", "outputs",
                           "_reason", "_src"))
