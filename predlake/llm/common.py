"""Helpers shared by the operators: tables, shared intermediate tables, models in broadcasts."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predlake.session import delete_at_exit

# Whole texts go to Python in batches of so many rows and bytes at most, which bounds what a task holds on both sides.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
                "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16777216b")}


def bound_batches(spark: SparkSession) -> None:
    """Lower the batch limits of a session that has left them at Spark's defaults."""
    for key, (default, limit) in BATCH_LIMITS.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, limit)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a single-machine session without the setting gets a folder of its own;
    on a cluster a missing setting is an error, as no local folder is shared.
    """
    bound_batches(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    It cuts the lineage: lost executors cost a re-read, not a recomputation,
    and a table that is used twice is computed once. What is derived from it is read
    lazily, so the folder is deleted when this process ends.
    """
    spark = df.sparkSession
    path = delete_at_exit(spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_of(doc_id, modulus: int):
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def per_process(key: str, make):
    """``make()`` once in a Python worker: what it gives outlives the task, as Spark reuses workers.

    Functions travel by value, so globals of their module are new in each task; the
    store therefore hangs on ``sys``. A new key replaces the last one of its kind (the
    part before the colon), so a worker holds one of each.
    """
    store = sys.__dict__.setdefault("_llm_per_process", {})
    kind = key.partition(":")[0]
    if kind not in store or store[kind][0] != key:
        store[kind] = (key, make())
    return store[kind][1]


def bounded_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows of least key hash. A first cut by the counted share keeps what tasks send on near ``rows`` in all."""
    order, whole = F.pmod(F.xxhash64(*keys), F.lit(1 << 40)), 1 << 40
    share = min(1.0, (1.2 * rows + 100) / max(1, df.count()))
    return df.where(order < int(share * whole)).orderBy(order, *keys).limit(rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn, rows: int) -> DataFrame:
    """(doc_id, text, y) of ``rows`` labelled documents at most: those of least id hash among the ids that ``learn`` allows.

    Labels other than 0 and 1 and null ids are left out; of several labels of one id the
    least counts. The chosen ids are broadcast: ``rows`` bounds them. Null texts count as
    empty; a label without a document gives no row.
    """
    chosen = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
              .where(learn(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y")))
    chosen = bounded_sample(chosen, ["doc_id"], rows)
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"))
