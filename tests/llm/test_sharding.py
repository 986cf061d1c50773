"""op9: the law of equal bytes, gapless slots and whole groups."""

import zlib
from collections import defaultdict

from predlake.llm import queries, sharding

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, shard int, part int"


def by_shard(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.shard].append(r)
    for s in out.values():
        s.sort(key=lambda r: r.slot)
        assert [r.slot for r in s] == list(range(len(s)))
    return out


def test_query_places_every_document(spark):
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_byte_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r["size"] == len(docs[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id]) and r.law == "bytes" and r.grown_shard is None for r in rows)
    shards = by_shard(rows)
    assert set(shards) <= set(range(40))
    # contiguous in the stated order, so shards don't interleave
    ends = [(min(r.text_crc32 for r in shards[s]), max(r.text_crc32 for r in shards[s])) for s in sorted(shards)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    target = sum(r["size"] for r in rows) / 40
    largest = max(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in s) - target) <= largest + 0.05 * target for s in shards.values())


def test_prefix_sums_equal_a_plain_walk(spark):
    rows = spark.createDataFrame([(i, "x" * (i % 7 + 1) + str(i), 0, 0) for i in range(500)], SCHEMA)
    got = sharding.shard_by_bytes(rows, shards=9, whole_group_share=0.0).collect()
    total, start = sum(r["size"] for r in got), 0
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        assert r.shard == min(8, int((start + r["size"] / 2) * 9 / total))
        start += r["size"]


def test_groups_whole_or_split(spark):
    rows = [(i, f"single {i}", 0, 0) for i in range(900)] + [(1000 + i, "pair", 0, 0) for i in range(2)] + [(2000 + i, "huge group", 0, 0) for i in range(600)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA), shards=10, whole_group_share=0.05).collect()
    sizes = [sum(r["size"] for r in s) for s in by_shard(got).values()]
    assert max(sizes) - min(sizes) <= 0.15 * sum(sizes) / 10
    assert len({r.shard for r in got if 1000 <= r.doc_id < 1002}) == 1
    assert len({r.shard for r in got if r.doc_id >= 2000}) >= 3


def test_nulls_empties_and_empty_table(spark):
    rows = spark.createDataFrame([(None, None, 7, 7), (1, "", 7, 7), (1, "", 7, 7), (2, "é", None, 7)], SCHEMA)
    got = sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in sharding.shard_by_bytes(rows, shards=3).collect())
    assert got == [(0, 16, 0), (1, 16, 0), (1, 16, 0), (2, 18, zlib.crc32("é".encode()))]
    assert sharding.shard_by_bytes(rows.limit(0)).count() == 0
