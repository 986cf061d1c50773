"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a unit vector are quantised separately by k-means; a pair of
centroids is a cell, and rows are packed cell by cell. A query takes the pairs in order of
summed distance from a heap (the multi-sequence algorithm) until their cells hold a given
part of all rows, and reranks the rows of those cells, and only those, by their exact
cosine. A query carries its farthest sum instead of a list of cells: a cell is
visited where its sum is no farther. A cell that holds much of the table is dealt
to as many tasks as any other rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, materialise
from .vectors import SLOT_QUERIES, by_length, longs, meet, pack, parts_of, query_slots, usable

CENTROIDS = 64          # of a half
FIT_ROWS = 8192         # the codebooks and the visited part are fitted on so many rows at most
FIT_QUERIES = 256       # rows of the sample that ask while the part is fitted
FIT_RECALL = 0.97
CROWDED = 4             # a cell counts as so many times the mean at most, so that one huge cell doesn't end the walk
SLACK = 1e-9            # between a matrix product and the exact cosine


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from k spread rows; an emptied centroid stays where it was."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = squared(x, centroids).argmin(axis=1)
        sums, n = np.zeros_like(centroids), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


def farthest_sum(first: np.ndarray, second: np.ndarray, held: np.ndarray, wanted: float) -> float:
    """Sum of the last centroid pair taken: pairs come off the heap by summed distance until they hold ``wanted`` rows."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, w = first[a].tolist(), second[b].tolist(), held[a][:, b].tolist()
    heap, reached, got, last = [(x[0] + y[0], 0, 0)], [0] * len(x), 0.0, -np.inf
    while heap and got < wanted:
        last, i, j = heapq.heappop(heap)
        got += w[i][j]
        # (i, j + 1) waits for the row above, (i + 1, j) for the column before: each pair enters once
        reached[i] = j + 1
        if j + 1 < len(y) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(x) and reached[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    return last


class Index:
    """Codebooks, rows per cell and the part of them to visit."""

    def __init__(self, sample: np.ndarray, neighbours: int) -> None:
        x, self.dim = unit(sample), sample.shape[1]
        half, k = self.dim // 2, max(1, min(CENTROIDS, len(x) // 16))
        self.books = (k_means(x[:, :half], k), k_means(x[:, half:], k))
        self.held = self.weights(np.bincount(self.cells(x), minlength=k * k))
        self.part = self._fit_part(x, neighbours)

    @classmethod
    def of(cls, state: dict) -> Index:
        """An index from its __dict__, which is what broadcasts carry."""
        index = cls.__new__(cls)
        index.__dict__ |= state
        return index

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.dim // 2
        return squared(x[:, :half], self.books[0]), squared(x[:, half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def weights(self, counts: np.ndarray) -> np.ndarray:
        k = len(self.books[0])
        return np.minimum(counts, CROWDED * max(1.0, counts.sum() / counts.size)).reshape(k, k)

    def reach(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return np.array([farthest_sum(f, s, self.held, self.part * self.held.sum()) for f, s in zip(a, b)])

    def _fit_part(self, x: np.ndarray, neighbours: int) -> float:
        """The least part, in steps of 5 %, whose recall on the sample is FIT_RECALL against brute force."""
        q = x[:: max(1, len(x) // FIT_QUERIES)]
        s = q @ x.T
        s[s > 1 - 1e-12] = -2  # itself and its copies
        n = min(neighbours, len(x))
        true = np.argpartition(-s, n - 1, axis=1)[:, :n]
        a, b = self.halves(q)
        of = self.cells(x)
        k = len(self.books[1])
        sums = a[:, of // k] + b[:, of % k]
        for part in np.arange(0.05, 1, 0.05):
            self.part = float(part)
            if (np.take_along_axis(sums, true, 1) <= self.reach(q)[:, None]).mean() >= FIT_RECALL:
                return self.part
        return 1.0


def fit(vectors: DataFrame, neighbours: int) -> Index | None:
    """An index fitted on the rows of least id hash, FIT_ROWS at most, of the commonest vector length."""
    sample = bounded_sample(vectors, ["vec_id"], FIT_ROWS).toPandas()
    if sample.empty:
        return None
    found = [m for _, _, m in by_length(sample.vec_id.to_numpy(np.int64), list(sample.vec))]
    return Index(max(found, key=len), neighbours)


def _pack_queries(model):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        index, out = Index.of(model.value), []
        for dim, ids, mat in by_length(pdf.vec_id.to_numpy(np.int64), list(pdf.vec)):
            reach = index.reach(unit(mat)) if dim == index.dim else np.full(len(ids), np.inf)
            out.append({"dim": dim, "slot": int(pdf.slot.iloc[0]), "qids": ids.tobytes(), "qmat": mat.tobytes(), "reach": reach.tobytes()})
        return pd.DataFrame(out)
    return run


def visited(index: Index, queries: np.ndarray, rows: np.ndarray, cells: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Cosines of queries and rows where a query visits a row's cell, else -inf; ``rows`` stand cell by cell."""
    s = np.full((len(queries), len(rows)), -np.inf)
    a, b = index.halves(queries)
    n = len(index.books[1])
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    for begin, end in zip(starts, np.append(starts[1:], len(cells))):
        who = np.flatnonzero(a[:, cells[begin] // n] + b[:, cells[begin] % n] <= reach + SLACK)
        if len(who):
            s[who, begin:end] = queries[who] @ rows[begin:end].T
    return s


def _rerank(model, k: int):
    def run(batches):
        index = Index.of(model.value)
        for pdf in batches:
            for r in pdf.itertuples():
                qids, ids = longs(r.qids), longs(r.ids)
                q = np.frombuffer(r.qmat, np.float64).reshape(len(qids), r.dim)
                x = np.frombuffer(r.mat, r.kind).reshape(len(ids), r.dim).astype(np.float64)
                uq, ux = unit(q), unit(x)
                if r.dim == index.dim:
                    s = visited(index, uq, ux, np.asarray(r.cells, np.int64), np.frombuffer(r.reach, np.float64))
                else:
                    s = uq @ ux.T
                s[qids[:, None] == ids[None, :]] = -np.inf
                m = min(k, len(ids))
                least = np.partition(s, len(ids) - m, axis=1)[:, len(ids) - m] - SLACK
                at, row = np.nonzero((s >= least[:, None]) & (s > -np.inf))
                dot = (q[at] * x[row]).sum(axis=1)
                exact = dot / (np.sqrt((q * q).sum(axis=1))[at] * np.sqrt((x * x).sum(axis=1))[row])
                out = pd.DataFrame({"query_id": qids[at], "vec_id": ids[row], "score": exact})
                out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                yield out.groupby("query_id").head(k)
    return run


def nearest(rows: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine in doubles): for each row whose id is divisible by ``every``
    the k nearest rows found, nearest first, ties to the smaller id; with fewer rows all found are given.

    Every row is indexed; only the codebooks and the visited part come from a bounded
    sample. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows with a null id. Vectors of another length than the sample's
    commonest are searched in full among their like. Rows that repeat an id are
    candidates one by one, never for their own id, and ask once. An empty table gives
    no rows.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vec_col).where(F.exists("vec", lambda x: x != 0))
    index = fit(vectors, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder = spark.sparkContext.broadcast(vars(index))

    @F.pandas_udf("int")
    def cell(vecs: pd.Series) -> pd.Series:
        index, out = Index.of(coder.value), np.full(len(vecs), -1, np.int32)
        for dim, at, mat in by_length(np.arange(len(vecs)), list(vecs)):
            if dim == index.dim:
                out[at] = index.cells(unit(mat))
        return pd.Series(out)

    def encode(dim: int, mat: np.ndarray) -> dict:
        index = Index.of(coder.value)
        cells = index.cells(unit(mat)) if dim == index.dim else np.zeros(0)
        narrow = mat.astype(np.float32)
        kept = narrow if (narrow == mat).all() else mat
        return {"cells": cells.astype(np.int32).tolist(), "kind": kept.dtype.str, "mat": kept.tobytes()}

    # one range order by cell and id: every task packs its cells one after the other
    posted = vectors.withColumn("cell", cell("vec")).repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    blocks = materialise(pack(posted.select("vec_id", "vec"), encode, "cells array<int>, kind string, mat binary"), "cells")
    held = blocks.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()  # CENTROIDS ** 2 rows at most
    counts = np.zeros(index.held.size)
    for r in held:
        counts[r["cell"]] = r["count"]
    index.held = index.weights(counts)
    model = spark.sparkContext.broadcast(vars(index))
    asked = vectors.where(F.col("vec_id") % every == 0).count()
    slots = max(1, -(-asked // SLOT_QUERIES))
    packed = materialise(query_slots(vectors, every, slots).groupBy("slot").applyInPandas(
        _pack_queries(model), "dim int, slot int, qids binary, qmat binary, reach binary"), "queries")
    found = (meet(blocks, packed, parts_of(blocks))
             .mapInPandas(_rerank(model, k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
