"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

Open bins are ordered by what is left of them. A piece looks for its successor,
the bin with the least room that holds it, and goes on to the next larger ones
until a bin without conflict is found; without one it opens a bin. Bins carry
bitmaps of the duplicate clusters and the sources that they hold: no bin holds
two pieces of a cluster, and at most SOURCE_REPEATS of a source, a bitmap for
each repeat. Pieces are packed from large to small.

Pieces are numbered from large to small (then by document, piece, source and cluster) and
dealt by their number to packing groups that are bounded in pieces and characters,
whatever their source or cluster; a group is packed in one task. Pieces that are equal in
all of these are alike, so the result does not depend on how Spark deals the rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .simhash import components_of, fingerprints

CAPACITY = 16_384         # characters of a bin
MARK = 1                  # what a piece takes besides its characters
SOURCE_REPEATS = 4        # pieces of one source in a bin at most
GROUP_PIECES = 4_096      # of a packing group
GROUP_BINS = 1_024


class Bins:
    """Open bins by room, each with its bitmaps."""

    def __init__(self, capacity: int, source_repeats: int) -> None:
        self.capacity, self.repeats = capacity, source_repeats
        self.by_room: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.used: list[int] = []
        self.pieces: list[int] = []

    def conflict(self, b: int, cluster_bit: int, source_bit: int) -> bool:
        return bool(self.clusters[b] & cluster_bit or self.sources[b][-1] & source_bit)

    def place(self, size: int, cluster_bit: int, source_bit: int) -> tuple[int, int, int]:
        """(bin, characters before the piece, pieces before it) of the tightest compatible bin."""
        at = bisect_left(self.by_room, (size, -1))
        while at < len(self.by_room) and self.conflict(self.by_room[at][1], cluster_bit, source_bit):
            at += 1
        if at < len(self.by_room):
            b = self.by_room.pop(at)[1]
        else:
            b = len(self.used)
            self.clusters.append(0)
            self.sources.append([0] * self.repeats)
            self.used.append(0)
            self.pieces.append(0)
        where = b, self.used[b], self.pieces[b]
        self.used[b] += size
        self.pieces[b] += 1
        self.clusters[b] |= cluster_bit
        planes = self.sources[b]
        planes[next(i for i, p in enumerate(planes) if not p & source_bit)] |= source_bit
        insort(self.by_room, (self.capacity - self.used[b], b))
        return where


def _bits(values: list, most: int) -> list[int]:
    """A bit for each value; none for values that too few pieces have to conflict."""
    codes = pd.factorize(np.array(values, dtype=object), use_na_sentinel=False)[0]
    often = np.flatnonzero(np.bincount(codes, minlength=1) > most).tolist()
    bit = {c: 1 << i for i, c in enumerate(often)}
    return [bit.get(c, 0) for c in codes.tolist()]


def pack(sizes: list[int], clusters: list, sources: list, capacity: int = CAPACITY, source_repeats: int = SOURCE_REPEATS) -> list[tuple[int, int, int]]:
    """(bin, offset, position) of each piece, in the order given."""
    cluster_bit, source_bit = _bits(clusters, 1), _bits(sources, source_repeats)
    bins, out = Bins(capacity, source_repeats), [(0, 0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = bins.place(sizes[i], cluster_bit[i], source_bit[i])
    return out


def numbered(pieces: DataFrame) -> DataFrame:
    """Adds n, the place of a piece in the order of packing, from per-partition totals of a range order."""
    order = [(F.col("start") - F.col("end")), "doc_id", "piece", "source", "cluster"]
    ranged = pieces.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # the partition, and the place in it
    ranged = materialise(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))), "pieces")
    totals = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = totals.select("_part", F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn("n", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, source_repeats: int = SOURCE_REPEATS) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start and end in code points, source, cluster, bin, offset, position.

    A text longer than a bin is cut into pieces that fill bins, so whole texts are
    packed. cluster is the SimHash component, so near copies never share a bin. Null
    and empty texts are one empty piece; all of them are copies of each other. A null
    source is a source of its own. Repeated rows and null ids are packed one by one.
    Bin numbers tell bins apart and have gaps. An empty table gives no rows.
    """
    step = capacity - MARK
    rows = materialise(fingerprints(docs.select("doc_id", "source", F.length(F.coalesce("text", F.lit(""))).alias("chars"), "text"),
                                    ["doc_id", "source", "chars"]), "lengths")
    known = rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.col("fp")))
    pieces = (rows.join(components_of(known, "_id"), "fp")
              .withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("chars") - 1) / step).cast("int")))))
              .withColumn("start", F.col("piece") * step).withColumn("end", F.least("chars", F.col("start") + step))
              .select("doc_id", "piece", "start", "end", "source", F.col("component_id").alias("cluster")))
    pieces = numbered(pieces)
    found = pieces.agg(F.count("*").alias("pieces"), F.sum(F.col("end") - F.col("start") + MARK).alias("chars")).first()
    groups = max(1, -(-found["pieces"] // GROUP_PIECES), -(-(found["chars"] or 0) // (GROUP_BINS * capacity)))
    kind = dict(pieces.dtypes)["doc_id"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        sizes = (pdf.end - pdf.start + MARK).tolist()
        placed = np.array(pack(sizes, pdf.cluster.tolist(), pdf.source.tolist(), capacity, source_repeats), np.int64).reshape(-1, 3)
        return pdf.drop(columns=["n", "group"]).assign(bin=placed[:, 0] + (int(pdf.group.iloc[0]) << 32), offset=placed[:, 1], position=placed[:, 2])

    return (pieces.withColumn("group", F.pmod("n", F.lit(groups)).cast("int")).groupBy("group").applyInPandas(
        run, f"doc_id {kind}, piece int, start int, end int, source string, cluster long, bin long, offset long, position int"))
