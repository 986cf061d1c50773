"""op10: whole texts, bounded bins, no conflicts, and the choice of the tightest bin."""

import random
from collections import Counter, defaultdict

from predlake.llm import packing, queries
from predlake.llm.simhash import simhash_groups

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, bin long, piece string"


def check(rows, texts, capacity=packing.CAPACITY, repeats=packing.SOURCE_REPEATS):
    """Every character of every text is in one piece; bins keep their laws."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.bin].append(r)
    assert pieces.keys() == texts.keys()
    for i, found in pieces.items():
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found)))
        assert "".join((texts[i] or "")[r.start:r.end] for r in found) == (texts[i] or "")
    for found in bins.values():
        found.sort(key=lambda r: r.position)
        at = 0
        for n, r in enumerate(found):
            assert (r.position, r.offset) == (n, at)
            at += r.end - r.start + packing.MARK
        assert at <= capacity
        assert len({r.cluster for r in found}) == len(found)
        assert max(Counter(r.source for r in found).values()) <= repeats
    return bins


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_best_fit_packing"](spark, SF).collect()
    check(rows, docs)
    clusters = {r.doc_id: r.component_id for r in simhash_groups(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert all(r.cluster == clusters[r.doc_id] for r in rows)


def plain_pack(sizes, clusters, sources, capacity, repeats):
    """Best fit by looking at every bin."""
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [b for b, held in enumerate(bins) if sum(sizes[j] for j in held) + sizes[i] <= capacity and all(clusters[j] != clusters[i] for j in held)
                and sum(sources[j] == sources[i] for j in held) < repeats]
        if fits:
            b = max(fits, key=lambda b: (sum(sizes[j] for j in bins[b]), -b))
        else:
            b = len(bins)
            bins.append([])
        bins[b].append(i)
        out[i] = b
    return out


def test_pack_equals_plain_best_fit():
    rng = random.Random(6)
    for _ in range(20):
        n = 120
        sizes = [rng.choice([1, 5, 9, 30, 64, 100]) for _ in range(n)]
        clusters = [rng.choice([0, 1, None, 100 + i]) for i in range(n)]
        sources = [rng.choice(["a", "a", "b", None]) for _ in range(n)]
        got = [b for b, _, _ in packing.pack(sizes, clusters, sources, 100, 3)]
        assert got == plain_pack(sizes, clusters, sources, 100, 3)


def test_nulls_empties_long_texts_and_extra_columns(spark):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "a b c d e", 5: "a b c d e"}
    rows = [(i, t, "s" if i % 2 else None, 3, "x") for i, t in texts.items()]
    got = packing.pack_documents(spark.createDataFrame(rows, SCHEMA))
    check(got.collect(), texts)
    again = packing.pack_documents(spark.createDataFrame([(None, "k l m", "s", 1, "x")] * 3, SCHEMA)).collect()
    assert len({r.bin for r in again}) == 3
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_result_does_not_depend_on_how_rows_are_dealt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))       # repeated rows among them
    seen = []
    for partitions, shuffle in ((3, 4), (11, 7)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            bins = defaultdict(list)
            for r in packing.pack_documents(docs.repartition(partitions)).collect():
                bins[r.bin].append((r.position, r.offset, r.doc_id, r.piece, r.start, r.end, r.source, r.cluster))
            seen.append({b: sorted(rows) for b, rows in bins.items()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]
