"""Contiguous shards of equal bytes from global prefix sums (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

ROW_BYTES = 16          # what a row costs besides its text
WHOLE_GROUP_SHARE = 0.05  # groups of equal texts up to this part of a shard are not cut


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                   whole_group_share: float = WHOLE_GROUP_SHARE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Rows stand in the order (crc32 of the text, its 64-bit hash, doc_id), so equal
    texts are neighbours. The rows are range-partitioned in that order; bytes and
    rows are totalled per partition, the few totals are summed to offsets, and a
    running sum inside each partition gives every row its place among all bytes. A
    row goes to the shard that holds its middle byte. A group of equal texts that a
    cut falls into goes whole to the shard of its own middle, unless it is larger
    than ``whole_group_share`` of a shard; larger groups are cut like other rows, so
    sizes differ from equal by half of the largest row or whole group at most.

    ``slot`` numbers a shard's rows from 0 in the same order. Null and empty texts
    have size 16 and crc32 0. Null ids come first among equal texts; repeated rows
    are placed one by one. An empty table gives no rows; more shards than rows leave
    shards empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ["text_crc32", "text_hash", "doc_id"]
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    part = materialise(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")

    totals = part.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (part.join(offsets, "part")
              .withColumn("end", F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("place", F.col("rows_before") + F.row_number().over(inside) - 1)
              .withColumn("start", F.col("end") - F.col("size"))
              .withColumn("row_shard", _shard_of((F.col("start") + F.col("end")) / 2, shards)))
    placed = materialise(placed.select(*order, "size", "start", "end", "place", "all_bytes", "row_shard"), "places")

    # at most shards - 1 groups hold a cut: those of the first rows of the shards
    first = placed.groupBy("row_shard").agg(F.min_by(F.struct("text_crc32", "text_hash"), "place").alias("g"))
    cut = (placed.join(F.broadcast(first.select("g.*").distinct()), ["text_crc32", "text_hash"])
           .groupBy("text_crc32", "text_hash")
           .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("all_bytes").alias("all_bytes"))
           .where((F.col("end") - F.col("start")) * shards <= F.col("all_bytes") * whole_group_share)
           .select("text_crc32", "text_hash", _shard_of((F.col("start") + F.col("end")) / 2, shards).alias("group_shard")))
    final = (placed.join(F.broadcast(cut), ["text_crc32", "text_hash"], "left")
             .withColumn("shard", F.coalesce("group_shard", "row_shard")))
    begins = final.groupBy("shard").agg(F.min("place").alias("begin"))
    return (final.join(F.broadcast(begins), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("place") - F.col("begin")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def _shard_of(middle, shards: int):
    return F.least(F.floor(middle * shards / F.col("all_bytes")), F.lit(shards - 1)).cast("int")
