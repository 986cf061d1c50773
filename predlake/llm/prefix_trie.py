"""Conversation prefix trie in balanced parentheses.

A node is a distinct sequence of first turns. Its key is the exclusive or of 128-bit
hashes of (place, role, text) over the sequence: such a key adds up over slices, so a
conversation that holds much of the table is ranked and keyed in slices of a global
range order, each slice by itself, with what came before it added from the slices'
totals. Texts are read once, for hashes and lengths, and never shuffled after that.

Distinct nodes are dealt to shards by the key of their ancestor at a cut depth (the
node itself above it, if it ends there). A shard also gets the ancestors of what it
holds: its spine. Every shard writes its nodes in preorder as balanced parentheses.
Blocks of the excess sequence have their least and greatest excess in a tree, on which
``find_close`` delimits all subtrees at once; the rank of leaf pairs ``()`` counts
leaves, and cumulative savings in preorder give a subtree's saving as a difference.
Spine nodes that several shards share are merged by adding up, and one of the shards
alone carries a spine node's own saving.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

GROUP, SHARED = 100, 6      # conversation c begins with crc32(c) % SHARED turns of c - c % GROUP
SHARD_NODES = 2_000         # nodes of a shard on average
UNIT_NODES = 2_000          # the cut goes down until no subtree below it is larger
CUTS = (1, 2, 4, 8, 16, 32)
BLOCK = 64
KEY = ["depth", "hi", "lo"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- balanced parentheses -------------------------------------------------------

class Parentheses:
    """A sequence of parentheses with the least and greatest excess of its blocks in a tree."""

    def __init__(self, opens: np.ndarray) -> None:
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        n = -(-len(opens) // BLOCK)
        padded = np.full(n * BLOCK, self.excess[-1] if len(opens) else 0, np.int64)
        padded[:len(opens)] = self.excess
        rows = padded.reshape(n, BLOCK)
        self.levels = [(rows.min(axis=1), rows.max(axis=1))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            if len(low) % 2:
                low, high = np.append(low, low[-1]), np.append(high, high[-1])
            self.levels.append((low.reshape(-1, 2).min(axis=1), high.reshape(-1, 2).max(axis=1)))

    def _holds(self, level: int, node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = node < len(low)
        at = np.minimum(node, len(low) - 1)
        return inside & (low[at] <= wanted) & (wanted <= high[at])

    def _scan(self, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first place of a wanted excess from ``start`` to the end of its block, or -1."""
        out = np.full(len(start), -1, np.int64)
        open_, at = np.arange(len(start)), start.copy()
        end = np.minimum((start // BLOCK + 1) * BLOCK, len(self.excess))
        while len(open_):
            alive = at[open_] < end[open_]
            open_ = open_[alive]
            hit = self.excess[at[open_]] == wanted[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return out

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        opens = np.asarray(opens, np.int64)
        wanted = self.excess[opens] - 1
        out = self._scan(opens + 1, wanted)
        # opens + 1 at a block's first place begins the next block, which the scan above has covered
        left = np.flatnonzero(out < 0)
        node, level = (opens[left] + 1) // BLOCK, np.zeros(len(left), np.int64)
        climbing = np.ones(len(left), bool)
        for k in range(len(self.levels)):
            now = np.flatnonzero(climbing)
            right = node[now] + 1
            hit = (node[now] % 2 == 0) & self._holds(k, right, wanted[left[now]])
            node[now[hit]], level[now[hit]] = right[hit], k
            climbing[now[hit]] = False
            node[now[~hit]] //= 2
        for k in range(len(self.levels) - 1, 0, -1):
            now = np.flatnonzero(level == k)
            child = node[now] * 2
            child += ~self._holds(k - 1, child, wanted[left[now]])
            node[now], level[now] = child, k - 1
        out[left] = self._scan(node * BLOCK, wanted[left])
        return out


def preorder(parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in preorder and the parentheses, from each node's parent (-1: the root). Siblings keep their order."""
    below: list[list[int]] = [[] for _ in parents]
    root = 0
    for i, p in enumerate(parents.tolist()):
        if p < 0:
            root = i
        else:
            below[p].append(i)
    order, opens, stack = [], [], [root]
    while stack:
        x = stack.pop()
        if x < 0:
            opens.append(False)
            continue
        order.append(x)
        opens.append(True)
        stack.append(-1)
        stack.extend(reversed(below[x]))
    return np.array(order), np.array(opens)


def subtree_sums(parents: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaves, weights) summed over each node's subtree, by node."""
    order, opens = preorder(parents)
    bp = Parentheses(opens)
    at = np.flatnonzero(opens)
    close = bp.find_close(at)
    pairs = np.concatenate([[0], np.cumsum(opens & ~np.append(opens[1:], True))])
    total = np.concatenate([[0], np.cumsum(weights[order])])
    first = np.arange(len(order))
    leaves, sums = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    leaves[order] = pairs[close] - pairs[at]
    sums[order] = total[first + (close - at + 1) // 2] - total[first]
    return leaves, sums


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(KEY).reset_index(drop=True)
    where = {k: i for i, k in enumerate(zip(pdf.depth, pdf.hi, pdf.lo))}
    parents = np.array([where[d - 1, a, b] if d else -1 for d, a, b in zip(pdf.depth, pdf.parent_hi, pdf.parent_lo)], np.int64)
    leaves, saved = subtree_sums(parents, np.where(pdf.owned, pdf.saving, 0))
    above = [None if p < 0 else int(pdf.conv_id[p]) for p in parents.tolist()]
    return pdf[KEY].assign(n_leaves=leaves, saved_tokens=saved, parent_conv_id=pd.array(above, dtype="Int64"))


# --- rebuilt conversations -------------------------------------------------------

def ranked_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, slice, rank, hi, lo, n): every turn's place in its conversation, with hashes and length instead of the text.

    Order: turn (null first), role, hash of the text. Slices are ranges of all turns in this order.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("b"), text, role).alias("b"), F.length(text).alias("n")).withColumn("row", F.monotonically_increasing_id())
    order = ["turn", "role", "a", "b", "row"]
    sliced = materialise(rows.repartitionByRange("conv_id", *order).withColumn("slice", F.spark_partition_id()), "slices")
    own = Window.partitionBy("conv_id", "slice").orderBy(*order)
    sizes = sliced.groupBy("conv_id", "slice").agg(F.count("*").alias("size"))
    before = sizes.select("conv_id", "slice", F.coalesce(F.sum("size").over(
        Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return (sliced.withColumn("_at", F.row_number().over(own)).join(before, ["conv_id", "slice"])
            .select("conv_id", "slice", (F.col("_at") + F.col("before")).alias("rank"), "a", "b", "n"))


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, turns; their turns: conv_id, slice, depth, a, b, n) by the rule of GROUP and SHARED."""
    sizes = ranked.groupBy("conv_id").agg(F.count("*").alias("size"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    first = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("long")
    convs = (sizes.withColumn("base", base).withColumn("first", first)
             .join(sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left")
             .withColumn("taken", F.least("first", F.coalesce("base_size", F.lit(0)))))
    begin = (ranked.where(F.col("rank") < SHARED).withColumnRenamed("conv_id", "base")
             .join(convs.select("conv_id", "base", "first"), "base").where(F.col("rank") <= F.col("first"))
             .select("conv_id", F.lit(-1).alias("slice"), F.col("rank").alias("depth"), "a", "b", "n"))
    rest = (ranked.join(convs.select("conv_id", "first", "taken"), "conv_id").where(F.col("rank") > F.col("first"))
            .select("conv_id", "slice", (F.col("rank") - F.col("first") + F.col("taken")).alias("depth"), "a", "b", "n"))
    turns = F.col("taken") + F.greatest(F.col("size") - F.col("first"), F.lit(0))
    return convs.select("conv_id", turns.alias("turns")), begin.unionByName(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, hi, lo, parent_hi, parent_lo, n): the key of every first part of every conversation."""
    rows = turns.withColumns({"a": F.xxhash64("depth", "a"), "b": F.xxhash64("b", "depth")})
    own = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "slice").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = totals.select("conv_id", "slice", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in "ab"])
    out = rows.withColumns({f"_{c}": F.bit_xor(c).over(own) for c in "ab"}).join(before, ["conv_id", "slice"])
    hi, lo = F.col("_a").bitwiseXOR(F.col("before_a")), F.col("_b").bitwiseXOR(F.col("before_b"))
    return out.select("conv_id", F.col("depth").cast("int").alias("depth"), hi.alias("hi"), lo.alias("lo"),
                      hi.bitwiseXOR(F.col("a")).alias("parent_hi"), lo.bitwiseXOR(F.col("b")).alias("parent_lo"), "n")


# --- nodes, shards, merge ------------------------------------------------------------

def trie_nodes(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """Distinct nodes: KEY, parent_hi, parent_lo, conv_id, n_convs, saving, n_children."""
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where(F.col("n_convs") > 0).select(
        F.lit(0).alias("depth"), zero.alias("hi"), zero.alias("lo"), zero.alias("parent_hi"), zero.alias("parent_lo"), "conv_id", "n_convs", F.lit(0).alias("n"))
    nodes = (paths.groupBy(*KEY).agg(F.min("parent_hi").alias("parent_hi"), F.min("parent_lo").alias("parent_lo"),
                                     F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n").alias("n"))
             .unionByName(root.select(*KEY, "parent_hi", "parent_lo", "conv_id", "n_convs", "n")))
    own = nodes.select(*KEY, "parent_hi", "parent_lo", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("n")).alias("saving"), zero.alias("child"))
    nothing = F.lit(None).cast("long")
    child = (nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo"))
             .agg(F.count("*").alias("child"))
             .select(*KEY, *[nothing.alias(c) for c in ("parent_hi", "parent_lo", "conv_id", "n_convs", "saving")], "child"))
    return own.unionByName(child).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("parent_hi", "parent_lo", "conv_id", "n_convs", "saving")], F.sum("child").alias("n_children"))


def with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes with ``path``: the keys of their ancestors and themselves down to the deepest cut (at most CUTS[-1] of them)."""
    heads = (paths.where(F.col("depth") <= CUTS[-1]).groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("depth", "hi", "lo"))).alias("head")))
    return (nodes.join(heads, "conv_id", "left")
            .withColumn("path", F.filter(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), lambda x: x["depth"] <= F.col("depth"))).drop("head"))


def unit(cut: int):
    """The subtree that a node is dealt with: the one below its ancestor at the cut, or itself."""
    return F.coalesce(F.get("path", F.lit(cut - 1)), F.struct("depth", "hi", "lo"))


def shard_rows(nodes: DataFrame, shard_nodes: int, unit_nodes: int) -> DataFrame:
    """Rows for the shards: every node once as owned by its shard, and spine nodes in each shard that lies below them."""
    cut = CUTS[-1]
    for d in CUTS:
        largest = (nodes.where(F.col("depth") >= d).groupBy(unit(d).alias("u")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0])
        if (largest or 0) <= unit_nodes:
            cut = d
            break
    shards = -(-nodes.count() // shard_nodes) or 1
    columns = [*KEY, "parent_hi", "parent_lo", "conv_id", "saving"]
    spine = (F.col("depth") < cut) & (F.col("n_children") > 0)
    shard = F.pmod(F.xxhash64(unit(cut)), F.lit(shards))
    own = nodes.where(~spine).select(shard.alias("shard"), *columns, F.lit(True).alias("owned"))
    tops = (nodes.where(~spine & (F.col("depth") <= cut)).select(shard.alias("shard"), F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"))),
        F.filter("path", lambda x: x["depth"] < F.col("depth")))).alias("x")).select("shard", "x.*").distinct())
    tops = tops.join(tops.groupBy(*KEY).agg(F.min("shard").alias("_owner")), KEY)
    above = nodes.where(spine).select(*columns).join(tops, KEY).select("shard", *columns, (F.col("shard") == F.col("_owner")).alias("owned"))
    return own.unionByName(above)


def _digests(batches):
    """Node by node, in order: SHA-256 over the ids, which are never held together."""
    key, digest, first = None, None, True
    for pdf in batches:
        out = []
        for d, a, b, c in zip(pdf.depth, pdf.hi, pdf.lo, pdf.conv_id):
            if (d, a, b) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest, first = (d, a, b), hashlib.sha256(), True
            digest.update(str(c).encode() if first else f",{c}".encode())
            first = False
        yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*KEY, "ends_sha256"])


def end_digests(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """KEY, ends_sha256 of nodes where conversations end."""
    zero = F.lit(0).cast("long")
    ends = (paths.join(convs, "conv_id").where(F.col("depth") == F.col("turns")).select(*KEY, "conv_id")
            .unionByName(convs.where(F.col("turns") == 0).select(F.lit(0).alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id")))
    return ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInPandas(_digests, "depth int, hi long, lo long, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_nodes: int = SHARD_NODES, unit_nodes: int = UNIT_NODES) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role, text. Rows with a null conv_id take no part. A null role or text counts as
    empty; a null turn comes first, turns of equal number go by role and then by the text's hash. Repeated rows
    are turns of their own. An empty table has no node, not even a root. Other columns do not matter.
    A shard holds whole subtrees below the cut, ``unit_nodes`` nodes at most unless many conversations share
    CUTS[-1] turns; the turns of one conversation below the cut stay together, without their texts.
    """
    ranked = materialise(ranked_turns(turns), "ranked")
    convs, rows = rebuilt(ranked)
    convs, paths = materialise(convs, "convs"), materialise(prefixes(rows), "paths")
    nodes = materialise(with_paths(trie_nodes(convs, paths), paths), "nodes")
    parts = shard_rows(nodes, shard_nodes, unit_nodes).groupBy("shard").applyInPandas(
        _shard, "depth int, hi long, lo long, n_leaves long, saved_tokens long, parent_conv_id long")
    nothing = {c: F.lit(None).cast("long") for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id")}

    def padded(df: DataFrame) -> DataFrame:
        more = {c: v for c, v in nothing.items() if c not in df.columns}
        return df.withColumns(more if "ends_sha256" in df.columns else more | {"ends_sha256": F.lit(None).cast("string")})

    pieces = [padded(nodes.select(*KEY, "conv_id", "n_convs", "n_children")), padded(parts), padded(end_digests(convs, paths))]
    merged = pieces[0].unionByName(pieces[1]).unionByName(pieces[2]).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children")],
        *[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")], F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
    return merged.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
