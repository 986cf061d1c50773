"""op12 against plain Lloyd rounds and its oracle; what migrates; edge cases."""

import hashlib
import math

import duckdb
import pytest

from predlake.llm import queries, vector_codes

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def plain(rows, n_parts=16, n_entries=64, rounds=2):
    """{vec_id: (code, error)} and the codebooks' digest, by loops over Python integers."""
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in sorted(rows)]
    width = len(q[0][1]) // n_parts
    parts = [[(i, v[p * width:(p + 1) * width]) for i, v in q] for p in range(n_parts)]
    codes, errors, books = {i: "" for i, _ in q}, {i: 0 for i, _ in q}, []
    for part in parts:
        book = [list(v) for _, v in part[:n_entries]]

        def pick(v):
            return min(((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book)))
        for _ in range(rounds):
            members = {}
            for _, v in part:
                members.setdefault(pick(v)[1], []).append(v)
            for k, vs in members.items():
                book[k] = [sum(c) // len(vs) for c in zip(*vs)]
        for i, v in part:
            d, k = pick(v)
            codes[i] += f"{k:02x}"
            errors[i] += d
        books.append(book)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return {i: (codes[i], errors[i]) for i in codes}, digest


def test_query_equals_plain_lloyd_and_its_oracle(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want, digest = plain([(r.vec_id, r.embedding) for r in table])
    rows = queries.QUERIES["op12_resident_lloyd"](spark, SF).collect()
    assert {r.vec_id: (r.code, r.error) for r in rows} == want
    assert {r.codebooks_sha256 for r in rows} == {digest}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert sorted(map(tuple, rows)) == sorted(duck.execute(queries.ORACLES["op12_resident_lloyd"]).fetchall())


def test_more_rounds_and_other_sizes(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").limit(90).collect()
    got, books = vector_codes.compress(spark.createDataFrame(table), n_parts=4, n_entries=7, rounds=5)
    want, digest = plain([(r.vec_id, r.embedding) for r in table], 4, 7, 5)
    assert {r.vec_id: (r.code, r.error) for r in got.collect()} == want
    assert vector_codes.codebooks_sha256(books) == digest


def test_only_parts_that_change_entry_are_shuffled(spark, monkeypatch):
    written = {}

    def spy(df, label, real=vector_codes.materialise):
        out = real(df, label)
        written.setdefault(label, []).append(out)
        return out
    monkeypatch.setattr(vector_codes, "materialise", spy)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vector_codes.compress(table)[0].count()
    members, moved = written["members"][0], written["moved"]
    assert len(moved) == vector_codes.ROUNDS
    assert members.count() == 16 * table.count()
    # each round's table holds parts in their new entry, every part at most once, and far from all of them
    for m in moved:
        assert m.count() == m.select("row", "position").distinct().count() < 0.5 * members.count()
    first = moved[0].alias("m").join(members.alias("o"), ["row", "position"]).where("m.entry = o.entry").count()
    assert first == 0


def test_bad_vectors_labels_ties_repeats_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float((i * j) % 7) / 8 for j in range(16)], None if i % 3 else i % 2, "x") for i in range(1, 40)]
    bad = [(50, None, 1, "x"), (51, [None] + [1.0] * 15, 1, "x"), (52, [nan] * 16, 1, "x"), (53, [inf] * 16, 1, "x"), (54, [], 1, "x"),
           (55, [1.0], 1, "x"), (56, [1e30] * 16, 1, "x")]
    rows = vector_codes.vector_codes(spark.createDataFrame(good + good[:2] + bad, SCHEMA)).collect()
    assert sorted(r.vec_id for r in rows) == sorted([g[0] for g in good] + [1, 2])
    sums = {}
    by_id = {g[0]: g[2] for g in good}
    for r in rows:
        sums[by_id[r.vec_id]] = sums.get(by_id[r.vec_id], 0) + r.error
    assert all(r.label_error == sums[by_id[r.vec_id]] for r in rows)
    assert len({r.code for r in rows if r.vec_id == 1}) == 1


def test_floors_go_down_and_ties_go_to_the_first_entry(spark):
    rows = [(1, [-0.001] * 16, 0, ""), (2, [0.001] * 16, 0, ""), (3, [-0.001] * 16, 0, "")]
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), n_entries=3)
    assert books[:, :, 0].tolist() == [[-1, 0, -1]] * 16
    assert {r.vec_id: r.code for r in got.collect()} == {1: "00" * 16, 2: "01" * 16, 3: "00" * 16}


def test_length_that_does_not_divide_and_null_ids(spark):
    rows = [(None, [float(i)] * 5, 1, "") for i in range(3)] + [(4, [0.5] * 5, None, "")]
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), n_parts=2, n_entries=2)
    # 128 and 0 begin; 256 and 512 join 128; then 128 and 0 are nearer to 0
    assert books[0].tolist() == [[384] * 3, [64] * 3] and books[1].tolist() == [[384, 384, 0], [64, 64, 0]]
    assert got.count() == 4


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single(spark, n):
    rows = vector_codes.vector_codes(spark.createDataFrame([(9, [0.25] * 32, 3, "x")][:n], SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in rows] == [(9, "00" * 16, 0, 0)][:n]
