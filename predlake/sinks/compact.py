"""K2: file rotation. A stream's micro-batch folders are compacted into files of a target size.

A micro-batch is one folder of the lake, committed when Spark's writer has put ``_SUCCESS`` in it.
Compaction reads the committed batches since the last compaction, all but the newest one
(a restarted stream may write that one again), writes their rows in files of about
``target_bytes``, and then publishes a manifest that names the compacted folders and the last
batch in them. A snapshot is what the newest manifest names plus the committed batches after it:
every row once, before, while and after a compaction runs, and while the stream writes on.
Of two compactions at a time one publishes; what the other wrote is named nowhere.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from predlake.functions.shared_files import create_once, delete_folder, exists, names_in
from predlake.sinks.parquet import BATCH

MANIFESTS = "manifests"
TARGET_BYTES = 128 << 20


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest manifest and its number."""
    names = sorted(names_in(spark, f"{path}/{MANIFESTS}"))
    if not names:
        return 0, {"folders": [], "through": -1}
    return int(names[-1].split(".")[0]), json.loads(spark.read.text(f"{path}/{MANIFESTS}/{names[-1]}").first()[0])


def _committed(spark: SparkSession, path: str, after: int) -> dict[int, int]:
    """Committed micro-batches after one, with their bytes."""
    found = {int(n.split("=")[1]): size for n, size in names_in(spark, path).items() if n.startswith(f"{BATCH}=")}
    return {b: size for b, size in sorted(found.items()) if b > after and exists(spark, f"{path}/{BATCH}={b}", "_SUCCESS")}


def compact(spark: SparkSession, path: str, schema: StructType, target_bytes: int = TARGET_BYTES) -> int:
    """Compact what has been committed since the last time; the number of batches taken (0 also where another compaction was first)."""
    number, manifest = _manifest(spark, path)
    batches = _committed(spark, path, manifest["through"])
    taken = sorted(batches)[:-1]
    if not taken:
        return 0
    folder = f"compacted/{taken[0]:09d}-{taken[-1]:09d}-{uuid.uuid4().hex[:8]}"
    files = max(1, -(-sum(batches[b] for b in taken) // target_bytes))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{BATCH}={b}" for b in taken])
    rows.repartition(files).write.option("compression", "snappy").parquet(f"{path}/{folder}")
    published = create_once(spark, f"{path}/{MANIFESTS}", f"{number + 1:09d}.json",
                            json.dumps({"folders": [*manifest["folders"], folder], "through": taken[-1]}))
    if not published:
        delete_folder(spark, f"{path}/{folder}")
    return len(taken) if published else 0


def snapshot_folders(spark: SparkSession, path: str) -> list[str]:
    _, manifest = _manifest(spark, path)
    return [f"{path}/{f}" for f in manifest["folders"]] + [f"{path}/{BATCH}={b}" for b in _committed(spark, path, manifest["through"])]


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All committed rows, each once."""
    folders = snapshot_folders(spark, path)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete micro-batch folders that a manifest has replaced; call it when no reader has an older snapshot open."""
    _, manifest = _manifest(spark, path)
    old = [b for b in _committed(spark, path, -1) if b <= manifest["through"]]
    for b in old:
        delete_folder(spark, f"{path}/{BATCH}={b}")
    return len(old)
