"""Vector code compression: Lloyd's rounds over resident members.

A row is one part of one vector. Rows are dealt once by (position, entry, salt), so the
members of an entry stand together in the partitions that own it, and a hot entry is
split over as many owners as there are salts. In a round every owner adds up its
resident members; the few sums for each (position, entry) give the new codebooks (of a
fixed size, sent to all tasks). Then each owner looks for its members' nearest entries.
Members that keep theirs stay where they are: nothing of them is shuffled or written.
Only parts whose entry changed go through the next shuffle, and are written as the
members that have come in. In the end the parts of a vector meet once, by row, for its code.

All arithmetic is in whole numbers, so results do not depend on order or salts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 19  # of a component; squared distances of 64 larger ones, scaled, would not fit a long


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, vec_id, label, q): rows whose vector has only finite components, in whole numbers."""
    v = F.col(vec_col)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    whole = df.where(usable).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("q"))
    return whole.withColumn("row", F.monotonically_increasing_id())


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the nearest entries of each part, and the squared distance."""
    d = np.zeros((len(parts), len(entries)), np.int64)
    for j in range(parts.shape[1]):
        d += (parts[:, j, None] - entries[None, :, j]) ** 2
    best = d.argmin(axis=1)
    return best, d[np.arange(len(parts)), best]


def _dealt(schema: StructType, books: np.ndarray, salts: int):
    """One row for each part with its entry; the vector's id and label go with the first part."""
    names, n_parts, width = schema.names, books.shape[0], books.shape[2]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q = np.zeros((n, n_parts * width), np.int64)
            flat = batch.column("q").flatten().to_numpy()
            q[:, :len(flat) // n] = flat.reshape(n, -1)
            q = q.reshape(n, n_parts, width)
            entry = np.stack([nearest(q[:, p], books[p])[0] for p in range(n_parts)], axis=1).astype(np.int32)
            row = batch.column("row").to_numpy()
            first = pa.array(np.repeat(np.arange(n), n_parts), mask=np.tile(np.arange(n_parts) > 0, n))
            columns = {
                "row": np.repeat(row, n_parts), "position": np.tile(np.arange(n_parts, dtype=np.int32), n), "entry": entry.ravel(),
                "salt": np.repeat(((row ^ (row >> 33)) % salts).astype(np.int32), n_parts),
                "part": pa.ListArray.from_arrays(np.arange(0, n * n_parts * width + 1, width, dtype=np.int32), q.ravel()),
                "vec_id": batch.column("vec_id").take(first), "label": batch.column("label").take(first)}
            yield pa.RecordBatch.from_arrays([pa.array(columns[k]) if isinstance(columns[k], np.ndarray) else columns[k] for k in names], names=names)
    return run


def _assigned(books: np.ndarray):
    @F.pandas_udf("entry int, error long")
    def run(position: pd.Series, part: pd.Series) -> pd.DataFrame:
        at, parts = position.to_numpy(), np.stack(part.to_numpy()).astype(np.int64) if len(part) else np.zeros((0, books.shape[2]), np.int64)
        entry, error = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
        for p in np.unique(at):
            mine = at == p
            entry[mine], error[mine] = nearest(parts[mine], books[p])
        return pd.DataFrame({"entry": entry, "error": error})
    return run


def first_books(kept: DataFrame, n_parts: int, n_entries: int) -> np.ndarray | None:
    """(position, entry, place): the parts of the vectors of the least ids; a vector that does not divide evenly ends in zeros."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(n_entries).select("q").collect()
    if not rows:
        return None
    width = -(-len(rows[0]["q"]) // n_parts)
    books = np.zeros((len(rows), n_parts * width), np.int64)
    books[:, :len(rows[0]["q"])] = [r["q"] for r in rows]
    return books.reshape(len(rows), n_parts, width).transpose(1, 0, 2).copy()


def updated(books: np.ndarray, members: DataFrame) -> np.ndarray:
    """Every entry moved to the floor of its members' mean; entries without members stay."""
    width = books.shape[2]
    sums = [F.sum(F.get("part", F.lit(i))).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for r in members.groupBy("position", "entry").agg(F.count("*").alias("n"), *sums).collect():  # at most positions x entries rows
        out[r["position"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) of every kept row, and the codebooks (position, entry, place).

    Vectors that are null, empty or hold null or non-finite components take no part, nor do those
    with components beyond LARGEST, whose errors fit no long, and those of another length than
    the vector of the least id. Repeated rows are coded one by one; a null id stands after all others.
    Of equally near entries the first is taken. An empty table gives no row and no codebooks; other
    columns do not matter.
    """
    spark = df.sparkSession
    kept = materialise(kept_vectors(df, id_col, vec_col, label_col), "kept")
    length = kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").select(F.size("q").alias("n")).limit(1).collect()
    kept = kept.where(F.size("q") == (length[0]["n"] if length else 0))
    books = first_books(kept, n_parts, n_entries)
    types = kept.schema
    if books is None:
        empty = StructType([types["vec_id"], types["label"], *StructType.fromDDL("code string, error long")])
        return spark.createDataFrame([], empty), None

    # as many salts as shuffle partitions: even an entry that holds a third of all rows falls on all of them
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([StructField("row", LongType()), *StructType.fromDDL("position int, entry int, salt int, part array<long>"), types["vec_id"], types["label"]])
    owners = ["position", "entry", "salt"]
    members = materialise(kept.mapInArrow(_dealt(schema, books, salts), schema).repartition(*owners), "members")
    for _ in range(rounds):
        books = updated(books, members)
        seen = members.withColumn("_to", _assigned(books)("position", "part"))
        move = F.col("_to.entry") != F.col("entry")
        moved = materialise(seen.where(move).withColumn("entry", F.col("_to.entry")).drop("_to").repartition(*owners), "moved")
        members = seen.where(~move).drop("_to").unionByName(moved)
    final = members.withColumn("_to", _assigned(books)("position", "part"))
    by_place = F.array_sort(F.collect_list(F.struct("position", F.col("_to.entry").alias("entry"))))  # n_parts of them
    digits = F.transform(by_place, lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0")))
    coded = final.groupBy("row").agg(F.max("vec_id").alias("vec_id"), F.max("label").alias("label"),
                                     F.concat_ws("", digits).alias("code"), F.sum("_to.error").alias("error"))
    return coded.drop("row"), books


def codebooks_sha256(books: np.ndarray | None) -> str:
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def vector_codes(df: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (the error summed over rows of an equal label, nulls together) and codebooks_sha256.

    A sum that fits no long is null. See ``compress`` for the rows that take part.
    """
    coded, books = compress(df)
    coded = materialise(coded, "coded")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return (coded.join(sums, coded["label"].eqNullSafe(sums["_label"]))
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))
