"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are hashed: pairs and triples of its code points (digits count as one) and
its words, of any script; and counts of words that repeat the word before. Their weights,
(1 + log tf) * idf, are projected on
the leading right singular vectors of the labelled sample. The labelled vectors,
bounded by FIT_ROWS, are broadcast; every document's cosine with each of them is
computed in blocks, and the nearest labels vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, split_of

FIT_ROWS = 4000     # labelled documents at most
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8       # a neighbour's vote is its cosine to this power
BLOCK = 512         # documents scored at once
HELD_OUT = (5, 0)   # ids with crc32 mod 5 == 0 are never learned from
ACCEPTED = 0.3      # predicted 1 from this score on


PAIRS, TRIPLES, WORDS = 2048, 4096, 2048    # hash buckets of each kind of term
REPEATED = PAIRS + TRIPLES + WORDS           # words equal to the one before, and to the two before
TERMS = REPEATED + 2
REPEATS = 4          # these two count so many times what another term counts
SEEDS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
LONGEST = 64         # code points of a word that its hash tells apart by their place
POWERS = np.cumprod(np.full(LONGEST, SEEDS[0], np.uint64))


def _buckets(h: np.ndarray, n: int) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * SEEDS[2] >> np.uint64(40)).astype(np.int64) % n


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(terms, how often each stands in a whole text), terms in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    space = (points <= 32) | (points == 0x85) | (points == 0xA0) | ((points >= 0x2000) & (points <= 0x200A)) | (points == 0x3000)
    read = np.where((points >= 48) & (points <= 57), np.uint64(48), np.where(space, np.uint64(32), points))
    found = [_buckets(read[:-1] * SEEDS[0] + read[1:] * SEEDS[1], PAIRS),
             PAIRS + _buckets(read[:-2] * SEEDS[0] + read[1:-1] * SEEDS[1] + read[2:] * SEEDS[2], TRIPLES)]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    if len(starts):
        inside = np.flatnonzero(~space)
        first = np.repeat(starts, np.diff(np.append(np.searchsorted(inside, starts), len(inside))))
        words = np.add.reduceat(points[inside] * POWERS[np.minimum(inside - first, LONGEST - 1)], np.searchsorted(inside, starts))
        same = words[1:] == words[:-1]
        found += [PAIRS + TRIPLES + _buckets(words, WORDS), np.full(int(same.sum()), REPEATED), np.full(int((same[1:] & same[:-1]).sum()), REPEATED + 1)]
    at, n = np.unique(np.concatenate(found), return_counts=True)
    return at, n.astype(np.float32)


def compressed(counts: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, bytes]:
    return counts[0].astype("<u2").tobytes(), counts[1].astype("<f4").tobytes()


def dense(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """(1 + log tf) * idf of a block of rows."""
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, (at, n) in enumerate(rows):
        x[i, at] = (1 + np.log(n)) * idf[at]
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def fit(rows: list[tuple[bytes, bytes]], y: np.ndarray, dimensions: int = DIMENSIONS) -> dict:
    """The projection and the labelled vectors, from compressed rows, which are spread out a block at a time."""
    y = np.asarray(y, np.float32)
    counts = [(np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(n, "<f4")) for at, n in rows]
    seen = np.zeros(TERMS)
    for at, _ in counts:
        seen[at] += 1
    idf = (1 + np.log((1 + len(y)) / (1 + seen))).astype(np.float32)
    idf[REPEATED:] *= REPEATS

    def blocks():
        for i in range(0, len(counts), BLOCK):
            yield i, dense(counts[i:i + BLOCK], idf)

    def times(q: np.ndarray) -> np.ndarray:
        out = np.zeros((len(counts), q.shape[1]), np.float32)
        for i, x in blocks():
            out[i:i + BLOCK] = x @ q
        return out

    def transposed(z: np.ndarray) -> np.ndarray:
        out = np.zeros((TERMS, z.shape[1]), np.float32)
        for i, x in blocks():
            out += x.T @ z[i:i + BLOCK]
        return out

    used = int((seen > 0).sum())
    d = min(dimensions, len(counts), used)
    basis = np.zeros((TERMS, max(1, d)), np.float32)
    if d:  # randomised subspace iteration for the leading right singular vectors
        q = np.random.default_rng(7).standard_normal((TERMS, min(d + 16, len(counts), used))).astype(np.float32)
        q[seen == 0] = 0
        for _ in range(6):
            q = np.linalg.qr(transposed(times(q)))[0]
        basis = (q @ np.linalg.svd(times(q), full_matrices=False)[2].T)[:, :d]
    vectors = unit(times(basis)) if len(counts) else np.zeros((0, basis.shape[1]), np.float32)
    return {"idf": idf, "basis": basis, "vectors": vectors.astype(np.float32), "y": y, "prior": float(y.mean()) if len(y) else 1.0}


def vote(counts: list[tuple[np.ndarray, np.ndarray]], model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity; texts without a term get the labels' mean."""
    n = min(neighbours, len(model["y"]))
    if not n:
        return np.full(len(counts), model["prior"])
    near = unit(dense(counts, model["idf"]) @ model["basis"]) @ model["vectors"].T
    at = np.argpartition(-near, n - 1, axis=1)[:, :n]
    w = np.maximum(np.take_along_axis(near, at, 1), 0).astype(np.float64) ** SHARPNESS
    total = w.sum(axis=1)
    return np.where(total > 0, (w * model["y"][at]).sum(axis=1) / np.maximum(total, 1e-300), model["prior"])


def _count(batches: Iterable[pd.DataFrame]):
    for pdf in batches:
        found = [compressed(terms(t)) for t in pdf.text]
        yield pd.DataFrame({"y": pdf.y.to_numpy(), "at": [at for at, _ in found], "n": [n for _, n in found]})


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    sample = labelled_sample(docs, labels, "quality", lambda i: split_of(i, HELD_OUT[0]) != HELD_OUT[1], fit_rows)
    # equal ones count once, so copies don't outvote others; and rows are bounded whatever number of them an id has
    counted = sample.select("text", "y").mapInPandas(_count, "y int, at binary, n binary").dropDuplicates(["y", "at", "n"])
    rows = counted.orderBy(F.xxhash64("at", "n", "y"), "at", "n", "y").limit(fit_rows).collect()
    rows = sorted((bytes(r["at"]), bytes(r["n"]), r["y"]) for r in rows)
    return fit([r[:2] for r in rows], np.array([r[2] for r in rows], np.float32))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, accepted: float = ACCEPTED) -> DataFrame:
    """The columns of ``docs`` with held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Learns from ``fit_rows`` labelled documents at most, none of them held out. Only the
    text is scored. Null and empty texts get the labels' mean, and without any label
    every score is 1. Repeated rows and null ids stay; columns of ``docs`` that are
    named like the three new ones are replaced. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fit_rows))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = [vote([terms(t or "") for t in texts.iloc[i:i + BLOCK]], model.value) for i in range(0, len(texts), BLOCK)]
        return pd.Series(np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0))

    return (docs.withColumn("held_out", split_of(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1])
            .withColumn("score", score(F.col("text"))).withColumn("predicted", (F.col("score") >= accepted).cast("int")))
