"""SimHash near-duplicates: 64-bit fingerprints, BK-trees over shards, connected components.

A fingerprint has a bit set where over half of a text's shingle hashes have it.
Two fingerprints link at ``radius`` or fewer differing bits. A tree over all
fingerprints would grow with the corpus and could not be broadcast, so the
shards are made by the pigeonhole principle: cut 64 bits in radius + 2 bands;
fingerprints within the radius agree in at least two bands, so every link meets
in one of the shards keyed by two bands. A shard of more than ``shard_rows``
fingerprints is dealt to sub-shards by hash, and every pair of its sub-shards is
searched in a task of its own: the tree of one, asked for the fingerprints of
the other. Trees and queries are bounded by ``shard_rows`` each. A shard
returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected_components

RADIUS = 2
SHARD_ROWS = 256
HASH_SEED = 42
CHUNK = 1 << 15  # hashes whose bits are counted at once


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a whole text; no words: 0.

    ASCII letters are lowered; bytes.split() without arguments cuts at just the
    six white-space characters x20 and x09 to x0D.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """The ``keep`` columns of every row with ``fp``, the fingerprint as a signed long. Null texts count as empty."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(*keep, fp(F.col(text_col)).alias("fp"))


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = (fp, {})
            return
        value, children = self.root
        while d := (value ^ fp).bit_count():
            child = children.get(d)
            if child is None:
                children[d] = (fp, {})
                return
            value, children = child

    def within(self, fp: int, radius: int) -> list[int]:
        """Values at most ``radius`` away: by the triangle inequality only edges of d - radius to d + radius lead to them."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            value, children = todo.pop()
            d = (value ^ fp).bit_count()
            if d <= radius:
                found.append(value)
            if children:
                todo += [c for e in range(d - radius, d + radius + 1) if (c := children.get(e))]
        return found


def forest(tree_side: list[int], query_side: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest (as stars) of the links inside ``tree_side``, or between it and ``query_side``."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    tree = BKTree()
    if query_side is None:
        queries = tree_side
    else:
        queries = query_side
        for x in tree_side:
            tree.add(x)
    for x in queries:
        for y in tree.within(x, radius):
            a, b = find(x), find(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if query_side is None:
            tree.add(x)
    return [(x, r) for x in list(parent) if (r := find(x)) != x]


def _search(radius: int):
    """Rows sorted by shard -> links. Holds one shard's fingerprints at a time."""
    def links(tree: list[int], other: list[int], same: bool):
        return forest(tree, None if same else other, radius)

    def run(batches):
        key, tree, other = None, [], []
        for pdf in batches:
            out: list[tuple[int, int]] = []
            rows = zip(pdf["band"].to_numpy(), pdf["bits"].to_numpy(), pdf["lo"].to_numpy(), pdf["hi"].to_numpy(),
                       pdf["shard"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64).tolist())
            for band, bits, lo, hi, shard, fp in rows:
                if (band, bits, lo, hi) != key:
                    if key is not None:
                        out += links(tree, other, key[2] == key[3])
                    key, tree, other = (band, bits, lo, hi), [], []
                (tree if shard == lo else other).append(fp)
            yield pairs(out)
        if key is not None:
            yield pairs(links(tree, other, key[2] == key[3]))

    def pairs(found: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame(np.array(found, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return run


def links(distinct: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """Distinct ``fp`` -> (a, b): edges whose components are those of all pairs within the radius."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]
    signed = [int(np.array(masks[i] | masks[j], np.uint64).view(np.int64)) for i, j in combinations(range(n), 2)]
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("int").alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(signed)
    ])).alias("k")).select("fp", "k.band", "k.bits")
    crowded = (keyed.groupBy("band", "bits").count().where("count > 1")
               .select("band", "bits", F.ceil(F.col("count") / shard_rows).cast("int").alias("shards")))
    dealt = keyed.join(crowded, ["band", "bits"]).withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
    tasks = (dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .select("band", "bits", F.least("shard", "o").alias("lo"), F.greatest("shard", "o").alias("hi"), "shard", "fp"))
    key = ["band", "bits", "lo", "hi"]
    return tasks.repartition(*key).sortWithinPartitions(*key).mapInPandas(_search(radius), "a bigint, b bigint")


def components_of(fps: DataFrame, id_col: str, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A table of ids and ``fp`` -> (fp, component_id), one row a fingerprint: the least id among all that are reachable."""
    least = fps.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    groups = connected_components(links(fps.select("fp").distinct(), radius, shard_rows))
    rooted = least.join(groups, least.fp == groups.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(of_root, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                   radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    component_id is the smallest id among all documents reachable over links;
    documents of equal fingerprint are linked, texts without words (null and
    empty ones) among them. Null ids are kept, take a group's smallest id, and
    null where the group has no id. Repeated rows stay repeated; other columns
    are not read. An empty table gives no rows.
    """
    fps = materialise(fingerprints(docs.select(F.col(id_col).alias("doc_id"), text_col), ["doc_id"], text_col, words_per_shingle), "fingerprints")
    return (fps.join(components_of(fps, "doc_id", radius, shard_rows), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the one of least id.

    A document without an id stands behind all others, known by its text's hash. Rows
    that repeat an id are one document, of which one row stays.
    """
    nameless = F.lit(1 << 62) + F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1))
    keyed = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), nameless))
    fps = materialise(fingerprints(keyed, ["_key"]), "fingerprints")
    kept = fps.join(components_of(fps, "_key"), "fp").where("_key = component_id").select("_key").distinct()
    again = materialise(fps.groupBy("_key").count().where("count > 1").select("_key"), "repeated")
    chosen = keyed.join(kept, "_key", "left_semi")
    once = chosen.join(again, "_key", "left_anti")
    more = chosen.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return once.unionByName(more).drop("_key")
