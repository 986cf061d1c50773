"""Session helpers: defaults for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Only applied where the session leaves them unset.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON objects with a repeated key keep the last value, like a Python dict.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "predlake", checkpoint: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on).

    ``checkpoint`` names the checkpoint folder (``spark.checkpoint.dir``);
    a cluster session gets it from its deployment instead.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PREDLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the engine's SQL defaults on a session someone else built.

    Only keys that are still at Spark's default are touched, so a cluster
    configuration always wins.
    """
    for k, v in SESSION_DEFAULTS.items():
        if k == "spark.sql.session.timeZone":
            # Results are defined in UTC; the driver compares against UTC oracles.
            spark.conf.set(k, v)
            continue
        cur = spark.conf.get(k, None)
        if cur is None or (k, cur) in (("spark.sql.mapKeyDedupPolicy", "EXCEPTION"), ("spark.sql.variant.allowDuplicateKeys", "false")):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The deployment sets it (a shared filesystem) and it is only read here. Only
    a single-machine session without it gets a folder of its own; elsewhere a
    missing setting is an error, as executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="predlake-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


# --- what a run leaves behind ----------------------------------------------------

_FOLDERS: list[tuple[SparkSession, str]] = []
_KEPT: list[DataFrame] = []


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder. What is read from it later is read lazily,
    so it is deleted when this process ends, and not before."""
    return delete_at_exit(spark, f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}")


def delete_at_exit(spark: SparkSession, path: str) -> str:
    """Delete a folder that this process makes when it ends."""
    _FOLDERS.append((spark, path))
    return path


@atexit.register
def _delete_folders() -> None:
    for spark, path in _FOLDERS:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session has been stopped, or its JVM is gone: the folder stays
            return


def kept(df: DataFrame) -> DataFrame:
    """``df`` persisted in memory and on disk (lost blocks are computed again); ``release_kept`` lets go of it."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(df)
    return df


def release_kept() -> None:
    """Unpersist all that ``kept`` holds. Frames that still need it are computed from their sources."""
    while _KEPT:
        _KEPT.pop().unpersist()
