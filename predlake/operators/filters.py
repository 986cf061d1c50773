"""Model filters on inferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from predlake.functions.barrier import where


def filter_models(inferences: DataFrame, model_name: str | None = None,
                  model_version: str | None = None) -> DataFrame:
    """Keep inferences of one model / version; an unset filter passes all.

    A NULL model name does not pass a set filter. Rows already refused (with a
    ``_reason``) pass through so they still reach the quarantine. F6 compares the version with
    ``model_version`` (the intended behaviour, B1).
    """
    df = inferences
    keep_rejects = F.col("_reason").isNotNull() if "_reason" in df.columns else F.lit(False)
    if model_name is not None:
        df = where(df, keep_rejects | (F.col("model_name") == F.lit(model_name)))
    if model_version is not None:
        df = where(df, keep_rejects | (F.col("model_version") == F.lit(model_version)))
    return df


def filter_spec(inferences: DataFrame, filters: dict[str, str] | None) -> DataFrame:
    filters = filters or {}
    return filter_models(inferences, filters.get("modelName"), filters.get("modelVersion"))
