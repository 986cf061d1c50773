"""F5 / F6 before the exchange: messages of keys that no wanted response belongs to are not shuffled.

A model filter looks at the response only, but a pair's request has to meet it first. So the
keys (ce_id, window) of all responses whose texts name the model are found, and whole keys without
one are left out before the pairing: what is left pairs as before, and the filter after the
pairing still decides. Keys are sent as a bitmap of their hashes, of a fixed size whatever
their number; a key that shares a bit with a wanted one stays in, which costs a little and changes nothing.
Refused messages stay, as they have no model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from predlake.functions.barrier import where
from predlake.functions.headers import header
from predlake.model import HEADER_ID, HEADER_TYPE, RESPONSE_TYPE

BITS = 27              # of the hash: a bitmap of 16 MB at most
BLOCK_BITS = 32_768    # of one of Spark's bitmaps


def _place(event_id: Column, window_start: Column) -> Column:
    return F.pmod(F.xxhash64(event_id, window_start), F.lit(1 << BITS))


def wanted_keys(envelopes: DataFrame, window_start: Column, model_name: str | None, model_version: str | None) -> DataFrame:
    """(_block, _bits): the bitmap of the keys with a response of the model; two fields of a response's text are read."""
    head = F.from_json(F.col("value").cast("string"), "model_name string, model_version string")
    keep = F.col("_head").isNotNull()
    for field, want in (("model_name", model_name), ("model_version", model_version)):
        if want is not None:
            keep = keep & (F.col(f"_head.{field}") == want)
    responses = envelopes.where(header(HEADER_TYPE) == RESPONSE_TYPE).withColumn("_head", head).where(keep)
    place = _place(header(HEADER_ID), window_start)
    return (responses.select(F.bitmap_bucket_number(place).alias("_block"), F.bitmap_bit_position(place).alias("_bit"))
            .groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def keep_wanted(classified: DataFrame, keys: DataFrame, window_start: Column) -> DataFrame:
    """Classified messages of keys in the bitmap, and the refused ones. Narrow: the bitmap is broadcast."""
    place = _place(F.col("event_id"), window_start)
    rows = classified.withColumn("_block", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)")
    is_set = F.coalesce(F.expr("shiftright({0}, cast(_bit % 8 as int)) & 1".format("_byte")) == 1, F.lit(False))
    joined = rows.join(F.broadcast(keys), "_block", "left").withColumn("_byte", byte)
    return where(joined, F.col("_reason").isNotNull() | is_set).drop("_block", "_bit", "_bits", "_byte")
