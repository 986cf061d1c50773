"""op6 against brute force, and its edge cases."""

import random
import re

import xxhash

from predlake.llm import queries, simhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fingerprint string, fp long"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Least index reachable over links of two bits or fewer, by all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    fps = [plain_fingerprint(t) for _, t in docs]
    roots = plain_components(fps)
    want = {(i, f"{fp:016x}", docs[r][0]) for (i, _), fp, r in zip(docs, fps, roots)}
    assert {tuple(r) for r in queries.QUERIES["op6_simhash_dedup"](spark, SF).collect()} == want


def test_fingerprint_words_and_case():
    for t in (None, "", " \t\n", "One", "one two", "A  b\tC\x0bd é É x", "ä b c " * 50):
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_links_keep_all_components(spark):
    """Random fingerprints, chains of neighbours and a crowd around one value, through shards of eight rows."""
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for start in list(fps)[:15]:
        for _ in range(6):
            start ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(start)
    crowd = rng.getrandbits(64)
    fps |= {crowd ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(120)}
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = [tuple(x % (1 << 64) for x in r) for r in simhash.links(spark.createDataFrame(signed, "fp long"), 2, 8).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    roots = plain_components(fps)
    for i, f in enumerate(fps):
        assert find(f) == find(fps[roots[i]])
    assert len({find(f) for f in fps}) == len(set(roots))


def test_tree_finds_exactly_the_radius():
    rng = random.Random(9)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_nulls_empties_repeats(spark):
    rows = [(5, None, "", 1), (3, "", None, 2), (4, " \n", "", 3), (None, "a b c d", "", 4), (9, "a b c d", "", 5), (9, "a b c d", "", 5), (None, "q r s t", "", 6)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect())
    a, q = (f"{plain_fingerprint(t):016x}" for t in ("a b c d", "q r s t"))
    zero = "0" * 16
    assert got[:5] == [(False, 3, zero, 3), (False, 4, zero, 3), (False, 5, zero, 3), (False, 9, a, 9), (False, 9, a, 9)]
    assert sorted((x[2], x[3]) for x in got[5:]) == sorted([(a, 9), (q, None)])
    assert simhash.simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each_group(spark):
    rows = [(5, "a b c d", "x", 1), (3, "A b  c d", "y", 2), (None, "a b c d", "z", 3), (None, "u v w x", "z", 4), (None, "u v w x", "z", 4), (8, "k l m n", "z", 5), (8, "k l m n", "z", 5)]
    got = simhash.one_of_each_group(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "fingerprint", "fp"]
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "u v w x"), (3, "A b  c d"), (8, "k l m n")]
