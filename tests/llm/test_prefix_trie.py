"""op13 against a trie of dictionaries and its oracle; parentheses against a plain matching; shards and spines; edge cases."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from predlake.llm import prefix_trie as trie
from predlake.llm import queries

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn int, role string, text string, depth string"


def plain(rows):
    """Sorted rows of the trie, by prefixes as tuples."""
    own = {}
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    nodes, ends = {}, {}
    for c, path in full.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])),
                    sum(q not in children for q in below), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_query_equals_plain_trie_and_its_oracle(spark):
    rows = got(queries.QUERIES["op13_prefix_trie"](spark, SF))
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows == plain(map(tuple, table))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    assert rows == sorted(duck.execute(queries.ORACLES["op13_prefix_trie"]).fetchall(), key=lambda r: r[:2])


def shared_turns():
    """Many conversations with a common beginning, copies of a whole one, a long one, and ones that end inside others."""
    rows = []
    for c in range(130):
        n = 1 + c % 7
        rows += [(c, t, "user" if t % 2 == 0 else "bot", "hello" if t < 3 else f"{c % 5} says {t}", "x") for t in range(n)]
    rows += [(1000 + c, t, "user", f"same {t}", "x") for c in range(40) for t in range(4)]
    rows += [(5001, t, "bot", f"step {t % 3}", "x") for t in range(90)]
    return rows


@pytest.mark.parametrize("shard_nodes,unit_nodes", [(trie.SHARD_NODES, trie.UNIT_NODES), (10, 20), (5, 1)])
def test_shards_and_spines_merge(spark, shard_nodes, unit_nodes):
    rows = shared_turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(trie.prefix_trie(df, shard_nodes, unit_nodes)) == plain(rows)


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(None, 1, "user", "lost", "x"), (7, None, "user", "first", "x"), (7, 1, None, None, "x"), (7, 1, "zz", "tie", "x"),
            (8, 0, "", "", "x"), (8, 0, "", "", "x"), (100, 0, "user", "base", "x"), (130, 5, "bot", "end", "x"), (130, 5, "bot", "end", "x")]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_turnless_conversations_end_at_the_root(spark):
    turnless = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(turnless, 0, "user", "gone", "x")]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows) == [
        (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_empty_table_and_long_texts(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(c, t, "user", "ä" * 200_000, "x") for c in (0, 100, 200) for t in range(6)]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10 ** 6), min_size=0, max_size=700), st.booleans())
def test_subtree_sums_equal_walks_up(choices, chain):
    parents = np.array([-1] + [(i if chain and c % 9 else c % (i + 1)) for i, c in enumerate(choices)], np.int64)
    weights = np.arange(len(parents)) * 7 % 11
    leaves, sums = trie.subtree_sums(parents, weights)
    want_leaves, want_sums = np.zeros(len(parents), int), np.zeros(len(parents), int)
    inner = set(parents.tolist())
    for i in range(len(parents)):
        x = i
        while x >= 0:
            want_leaves[x] += i not in inner
            want_sums[x] += weights[i]
            x = parents[x]
    assert leaves.tolist() == want_leaves.tolist() and sums.tolist() == want_sums.tolist()


def test_find_close_equals_a_stack():
    rng = np.random.default_rng(5)
    for n in (1, 31, 32, 33, 64, 500, 3000):
        parents = np.array([-1] + [max(0, i - int(rng.integers(0, 40))) for i in range(n - 1)])
        opens = trie.preorder(parents)[1]
        stack, want = [], {}
        for i, o in enumerate(opens.tolist()):
            if o:
                stack.append(i)
            else:
                want[stack.pop()] = i
        at = np.flatnonzero(opens)
        assert trie.Parentheses(opens).find_close(at).tolist() == [want[i] for i in at.tolist()]
