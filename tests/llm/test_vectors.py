"""op5 and op7 against brute force, and their edge cases."""

import duckdb
import numpy as np
import pytest

from predlake.llm import ann, queries, topk

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, rank int, slot string"


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    return rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64)


def brute(ids, keep, score, k):
    """{query: [(vec_id, score)]} by a plain sort."""
    return {q: [(int(b), s) for s, b in sorted(((score(i, j), ids[j]) for j in range(len(ids)) if ids[j] != q), key=lambda x: (-x[0], x[1]))[:k]]
            for i, q in enumerate(ids) if keep(q)}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_topk_query_equals_brute_force(spark, table):
    ids, x = table
    q = np.floor(64 * x).astype(np.int64)
    s = q @ q.T
    assert answers(queries.QUERIES["op7_topk_histogram"](spark, SF)) == brute(ids, lambda i: i % 20 == 0, lambda i, j: int(s[i, j]), 20)


def test_topk_query_equals_its_oracle(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = duck.execute(queries.ORACLES["op7_topk_histogram"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op7_topk_histogram"](spark, SF).collect())) == sorted(want)


def test_topk_ties_nulls_repeats_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 9, "x"), (20, [-1.0, 0.0], 9, None), (7, [0.5, 0.5], 9, "x"), (8, [0.5, 0.1], 9, "x"), (8, [0.5, 0.1], 9, "x"),
            (9, [0.5, 9.0], 9, "x"), (40, None, 1, "x"), (41, [None, 1.0], 1, "x"), (42, [nan, 1.0], 1, "x"), (43, [inf, 1.0], 1, "x"),
            (None, [1.0, 1.0], 1, "x"), (44, [1.0], 1, "x")]
    got = answers(topk.top_k(spark.createDataFrame(rows, SCHEMA), k=3))
    assert got == {0: [(7, 2048), (8, 2048), (8, 2048)], 20: [(7, -2048), (8, -2048), (8, -2048)]}


def test_topk_many_ties_and_empty(spark):
    rows = [(i, [1.0, float(i % 2)], 0, "") for i in range(120)]
    got = answers(topk.top_k(spark.createDataFrame(rows, SCHEMA), k=5))
    assert got[0] == [(i, 4096) for i in range(1, 6)]
    assert got[20] == [(i, 4096) for i in range(5)]
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_topk_wide_scores(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(6) * 1e5).tolist(), 0, "") for i in range(60)]
    ids, q = np.arange(60), np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64)
    s = q @ q.T
    assert answers(topk.top_k(spark.createDataFrame(rows, SCHEMA), k=4)) == brute(ids, lambda i: i % 20 == 0, lambda i, j: int(s[i, j]), 4)


def test_topk_one_large_vector(spark):
    rng = np.random.default_rng(6)
    small = [(i, rng.standard_normal(4).tolist(), 0, "") for i in range(30)]
    rows = small + [(40, [1e9, -1e9, 1e9, 1e9], 0, ""), (41, [1e19, 0.0, 0.0, 0.0], 0, ""), (60, [-1e9, 1e9, 1e9, -2e9], 0, "")]
    kept = [r for r in rows if r[0] != 41]                       # no long when scaled
    ids, q = [r[0] for r in kept], [[int(np.floor(64 * x)) for x in r[1]] for r in kept]

    def score(i, j):
        return sum(a * b for a, b in zip(q[i], q[j]))
    want = brute(ids, lambda i: i % 20 == 0, score, 4)
    want = {i: [x for x in brute(ids, lambda i: i % 20 == 0, score, 40)[i] if abs(x[1]) < topk.LARGEST][:4] for i in want}
    assert answers(topk.top_k(spark.createDataFrame(rows, SCHEMA), k=4)) == want
    assert any(abs(score(ids.index(40), ids.index(60))) >= topk.LARGEST for _ in "x")


def test_shuffled_rows_do_not_grow_with_the_number_of_slots(spark, table, monkeypatch):
    from predlake.llm import vectors
    ids, x = table
    blocks = spark.createDataFrame([(64, i, b"") for i in range(50)], "dim int, block long, ids binary")
    slots = spark.createDataFrame([(64, i, b"") for i in range(20)], "dim int, slot int, qids binary")
    met = vectors.meet(blocks, slots, 8)
    assert met.count() == 1000 and met.groupBy("block").count().where("count <> 20").count() == 0
    assert met.select("block", "part").distinct().count() == 50      # a block is in one part only


def test_copies_of_the_queries_are_not_gathered_on_the_driver(spark):
    from predlake.llm.vectors import meet
    blocks = spark.createDataFrame([(4, i) for i in range(40)], "dim int, block long")
    queries = spark.createDataFrame([(4, s) for s in range(3)] + [(5, 9)], "dim int, slot int")
    met = meet(blocks, queries, 7)
    assert sorted((r.block, r.slot) for r in met.collect()) == [(b, s) for b in range(40) for s in range(3)]
    assert "Broadcast" not in met._jdf.queryExecution().toString()


def test_ann_query_recall_and_scores(spark, table):
    ids, x = table
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = brute(ids, lambda i: i % 50 == 0, lambda i, j: float(u[i] @ u[j]), 5)
    got = answers(queries.QUERIES["op5_inverted_multi_index"](spark, SF))
    assert got.keys() == want.keys()
    at = {int(i): n for n, i in enumerate(ids)}
    for q, found in got.items():
        assert all(abs(s - u[at[q]] @ u[at[v]]) < 1e-12 for v, s in found)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_ann_recall_on_a_larger_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64)
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {int(q): set(ids[np.lexsort((ids, -s[i]))[:5]].tolist()) for i, q in enumerate(ids) if q % 50 == 0}
    got = answers(queries.QUERIES["op5_inverted_multi_index"](spark, "/root/testdata/sf0.01"))
    assert got.keys() == want.keys()
    assert sum(len({v for v, _ in got[q]} & want[q]) for q in want) >= 0.9 * 5 * len(want)


def test_ann_multiplies_visited_cells_only():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((20, 16)) * 4
    x = ann.unit(centres[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 16)) * 0.3)
    index = ann.Index(x, 5)
    cells = index.cells(x)
    order = np.argsort(cells, kind="stable")
    q = x[::60]
    s = ann.visited(index, q, x[order], cells[order], index.reach(q))
    seen = s > -np.inf
    assert seen.mean() < 0.35                                    # clustered rows: most cells are never read
    assert np.allclose(s[seen], (q @ x[order].T)[seen])
    a, b = index.halves(q)
    n = len(index.books[1])
    assert (seen == (a[:, cells[order] // n] + b[:, cells[order] % n] <= index.reach(q)[:, None] + ann.SLACK)).all()


def test_ann_zero_null_ties_and_empty(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (1, [2.0, 0.0], 0, ""), (2, [3.0, 0.0], 0, ""), (3, [0.0, 0.0], 0, ""), (4, None, 0, ""), (5, [float("nan"), 0.0], 0, ""),
            (6, [-1.0, 0.0], 0, ""), (50, [0.0, 1.0], 0, "")]
    got = answers(ann.nearest(spark.createDataFrame(rows, SCHEMA), k=2))
    assert got[0] == [(1, 1.0), (2, 1.0)]
    assert got[50] == [(0, 0.0), (1, 0.0)]
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_multi_sequence_walk_takes_pairs_by_summed_distance():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b, held = rng.random(6), rng.random(5), rng.integers(0, 4, (6, 5)).astype(float)
        order = sorted((a[i] + b[j], held[i, j]) for i in range(6) for j in range(5))
        for wanted in (1.0, held.sum() / 2, held.sum()):
            total, last = 0.0, None
            for d, n in order:
                if total >= wanted:
                    break
                total, last = total + n, d
            assert ann.farthest_sum(a, b, held, wanted) == pytest.approx(last)
