"""Exact top-k inner products by distributed histogram selection.

Every pair of a query and a row is scored, three or so times. A pass counts, for
each query, the scores in buckets of one width; the summed histogram shows which
bucket holds the kth highest score and how many scores lie above it. The next
pass cuts just that bucket into finer ones, until a bucket is one integer wide:
the kth value itself. The last pass keeps what is above it and, of the ties, as
many smallest ids as are missing. A task sends a query's buckets from the top
only until they hold as many scores as are still sought: the kth highest of all
rows is no lower than the kth highest of a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .vectors import SLOT_QUERIES, by_length, longs, meet, pack, parts_of, query_slots, usable

BUCKETS = 4096     # of a pass, for each query
LARGEST = 1 << 61  # scores are below it in size: so a range of scores fits a long
NONE = np.iinfo(np.int64).min  # in place of a score that does not count


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, in the narrowest integer type that holds it."""
    q = np.floor(scale * x).astype(np.int64)
    top = max(int(q.max()), -int(q.min())) if q.size else 0
    return q.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact, which is faster, and in whole numbers
    without a bound where a long could overflow. NONE where the product is LARGEST or more in size."""
    top = [max(int(m.max()), -int(m.min())) if m.size else 0 for m in (queries, rows)]
    most = max(1, queries.shape[1]) * top[0] * top[1]
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < LARGEST:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    wide = queries.astype(object) @ rows.astype(object).T
    return np.where(np.abs(wide) < LARGEST, wide, NONE).astype(np.int64)


def _matrix(blob: bytes, kind: str, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(blob, kind).reshape(n, dim)


def _pair(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids, scores, each query's lower end and number sought; a query's own rows have the least score."""
    qids, ids = longs(r.qids), longs(r.ids)
    s = scores(_matrix(r.qmat, r.qkind, r.dim, len(qids)), _matrix(r.mat, r.kind, r.dim, len(ids)))
    s[qids[:, None] == ids[None, :]] = NONE
    return qids, ids, s, longs(r.qlow), longs(r.qneed)


def _pack_queries(scale: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        out = []
        for dim, ids, mat in by_length(pdf.vec_id.to_numpy(np.int64), list(pdf.vec)):
            q, at = quantise(mat, scale), pdf.set_index("vec_id").loc[ids]
            out.append({"dim": dim, "slot": int(pdf.slot.iloc[0]), "qids": ids.tobytes(), "qmat": q.tobytes(), "qkind": q.dtype.str,
                        "qlow": at.low.to_numpy(np.int64).tobytes(), "qneed": at.need.to_numpy(np.int64).tobytes()})
        return pd.DataFrame(out)
    return run


def _histogram(width: int, span: int):
    """(vec_id, bucket, n) from the top bucket down; scores below the range of this pass don't count, those above were counted before."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                qids, ids, s, low, need = _pair(r)
                inside = (s >= low[:, None]) & (s < low[:, None] + span)
                bucket = np.where(inside, (s - np.where(inside, low[:, None], s)) // width, -1)
                k = min(int(need.max()), len(ids))
                least = np.partition(bucket, len(ids) - k, axis=1)[:, len(ids) - k]
                q, at = np.nonzero((bucket >= np.maximum(least, 0)[:, None]))
                found, n = np.unique(q * BUCKETS + bucket[q, at], return_counts=True)
                yield pd.DataFrame({"vec_id": qids[found // BUCKETS], "bucket": found % BUCKETS, "n": n})
    return run


def _select():
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                qids, ids, s, kth, need = _pair(r)
                s = s[:, order := np.argsort(ids, kind="stable")]
                own = s == NONE
                tie = (s == kth[:, None]) & ~own
                keep = ((s > kth[:, None]) & ~own) | (tie & (np.cumsum(tie, axis=1) <= need[:, None]))
                q, at = np.nonzero(keep)
                yield pd.DataFrame({"query_id": qids[q], "vec_id": ids[order][at], "score": s[q, at]})
    return run


def top_k(rows: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by ``every`` its k highest integer
    inner products of floor(scale * x) with the other rows; ties go to the smaller id, and with fewer rows all are given.

    Vectors that are null or hold null or non-finite components take no part, nor do
    rows with a null id; vectors of different length don't meet. Rows that repeat an
    id are candidates one by one, never for their own id, and ask once. Scores are longs:
    a vector with a component that is no long when scaled takes no part, and a pair whose
    score is 2 ** 61 or more in size is no pair. An empty table gives no rows.
    """
    vectors = usable(rows, id_col, vec_col).where(F.forall("vec", lambda x: F.abs(x.cast("double") * scale) < float(1 << 63)))

    def encode(dim: int, mat: np.ndarray) -> dict:
        q = quantise(mat, scale)
        return {"n": len(q), "top": float(max(int(q.max()), -int(q.min()))) if q.size else 0.0, "kind": q.dtype.str, "mat": q.tobytes()}

    blocks = materialise(pack(vectors, encode, "n int, top double, kind string, mat binary"), "blocks")
    top, dim, asked = (blocks.agg(F.max("top"), F.max("dim")).first() or (0, 0)) + (vectors.where(F.col("vec_id") % every == 0).count(),)
    bound = min((dim or 0) * int(top or 0) ** 2, LARGEST)
    parts = parts_of(blocks)
    slots = max(1, -(-asked // SLOT_QUERIES))
    queries = materialise(query_slots(vectors, every, slots), "queries")
    state = queries.select("vec_id", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    packed_schema = "dim int, slot int, qids binary, qmat binary, qkind string, qlow binary, qneed binary"

    def pairs() -> DataFrame:
        packed = queries.join(state, "vec_id").groupBy("slot").applyInPandas(_pack_queries(scale), packed_schema)
        return meet(blocks, packed, parts)

    span = 2 * bound + 1
    while span > 1:
        width = -(-span // BUCKETS)
        counts = (pairs().mapInPandas(_histogram(width, span), "vec_id long, bucket long, n long")
                  .groupBy("vec_id", "bucket").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("vec_id").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
        holds = (state.join(counts, "vec_id").withColumn("upto", F.sum("n").over(down))
                 .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
                 .select("vec_id", (F.col("low") + F.col("bucket") * width).alias("new_low"),
                         (F.col("need") - F.col("upto") + F.col("n")).alias("new_need")))
        # a query with fewer rows than k keeps its range: all its rows are taken
        state = materialise(state.join(holds, "vec_id", "left").select(
            "vec_id", F.coalesce("new_low", "low").alias("low"), F.coalesce("new_need", "need").alias("need")), "kth")
        span = width
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs().mapInPandas(_select(), "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
