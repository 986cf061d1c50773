"""K2: the Parquet lake sink behind the ``parquet`` destination.

Defaults: snappy, one ``path``; user options are merged last and win. Only
``parquet`` is a known format; anything else is refused before a query starts.
Tiny files are avoided by not flushing per record: ``maxRecordsPerFile``
bounds file size instead, and the stream trigger sets the landing delay.
"""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

KNOWN_FORMATS = {"parquet"}
DEFAULT_OPTIONS = {"compression": "snappy"}
DEFAULT_TRIGGER = "20 seconds"   # rotation interval of the file landing
BATCH = "logger_batch"           # folder of a micro-batch
VERSION = "schema_version"       # folder of a schema version, where the schema may grow


def _check(config: dict[str, Any]) -> tuple[str, dict[str, str]]:
    fmt = config.get("format", "parquet")
    if fmt not in KNOWN_FORMATS:
        raise ValueError(f"unknown destination format {fmt!r}")
    if "url" not in config:
        raise ValueError("destination needs a 'url'")
    opts = {**DEFAULT_OPTIONS, **{k: str(v) for k, v in (config.get("options") or {}).items()}}
    if "maxRecordsPerFile" in config:
        opts["maxRecordsPerFile"] = str(config["maxRecordsPerFile"])
    return config["url"].rstrip("/"), opts


def write_batch(rows: DataFrame, config: dict[str, Any], logger_name: str,
                mode: str = "append") -> str:
    """Write a logger's rows under ``<url>/<logger_name>``.

    A micro-batch (``batch`` in the config) gets a folder of its own, which a
    repeat of the batch overwrites: exactly once per checkpoint.
    """
    url, opts = _check(config)
    path = f"{url}/{logger_name}"
    if config.get("version") is not None:
        path = f"{path}/{VERSION}={config['version']}"
    if config.get("batch") is not None:
        path, mode = f"{path}/{BATCH}={config['batch']}", "overwrite"
    w = rows.write.mode(mode).options(**opts)
    if config.get("partitionBy"):
        w = w.partitionBy(*config["partitionBy"])
    w.parquet(path)
    return path


def read_versions(spark: SparkSession, path: str, schemas: list) -> DataFrame:
    """Rows of all schema versions under ``path`` in the columns of the last one of ``schemas``, with their version.

    Files of an earlier version are read by its own schema; columns that it lacks are null, integers widen.
    Versions that no row was written under are left out.
    """
    latest, out = schemas[-1].struct_type(), None
    for s in schemas:
        try:
            rows = spark.read.schema(s.struct_type()).parquet(f"{path}/{VERSION}={s.version}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        have = {f.name for f in s.struct_type()}
        rows = rows.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in latest],
                           F.lit(s.version).alias(VERSION))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], T.StructType([*latest.fields, T.StructField(VERSION, T.IntegerType())]))
