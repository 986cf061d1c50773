"""Blocks of vectors, and every query block against every block of the table.

Rows are packed where they are read: each task cuts its rows into blocks of at
most ``BLOCK_ROWS``, so no key and no copy of a vector gathers rows. Queries are
dealt by the hash of their id into slots of about ``SLOT_QUERIES`` rows. Blocks are
dealt to parts, as many as there are shuffle partitions, once; the slots go to every part.
So what is shuffled is the rows once and the queries as often as there are tasks, and does
not grow with the square of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
SLOT_QUERIES = 512


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of rows whose vector is not null and has finite components only. Rows with a null id can't be named and take no part."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(F.forall("vec", finite)))


def query_slots(vectors: DataFrame, every: int, slots: int) -> DataFrame:
    """(vec_id, vec, slot) of the ids divisible by ``every``; of rows that repeat an id the least vector asks."""
    return (vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
            .withColumn("slot", F.pmod(F.xxhash64("vec_id"), F.lit(slots)).cast("int")))


def by_length(ids: np.ndarray, vecs: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, float64 matrix) for each vector length: only vectors of one length can be compared."""
    lengths = np.array([len(v) for v in vecs], np.int64)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), ids[at], np.array([vecs[i] for i in at], np.float64).reshape(len(at), n)


def pack(vectors: DataFrame, encode: Callable[[int, np.ndarray], dict], schema: str) -> DataFrame:
    """One row per block: dim, block, ids (binary longs) and what ``encode(dim, matrix)`` gives."""
    def run(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        for pdf in batches:
            out = []
            for dim, ids, mat in by_length(pdf.vec_id.to_numpy(np.int64), list(pdf.vec)):
                for i in range(0, len(ids), BLOCK_ROWS):
                    out.append({"dim": dim, "block": part * 1_000_003 + block, "ids": ids[i:i + BLOCK_ROWS].tobytes()}
                               | encode(dim, mat[i:i + BLOCK_ROWS]))
                    block += 1
            if out:
                yield pd.DataFrame(out)
    return vectors.mapInPandas(run, f"dim int, block long, ids binary, {schema}")


def parts_of(blocks: DataFrame) -> int:
    """Tasks that blocks are dealt to: the session's shuffle partitions, but no more than there are blocks."""
    return max(1, min(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks.count()))


def meet(blocks: DataFrame, packed_queries: DataFrame, parts: int) -> DataFrame:
    """Each block beside each slot of queries of its dimension, in the block's part.

    Spark takes the slots for as small as their files, before they are repeated for each part, so it would gather all
    copies on the driver to broadcast them: the join is by a sort, whatever the size.
    """
    left = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    right = packed_queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(right.hint("merge"), ["dim", "part"])


def longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64)
