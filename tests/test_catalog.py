"""The schema catalog: versions are created once, starters agree, types join in a lattice."""

import pytest
from hypothesis import given, strategies as st

from predlake.operators import schema as S
from predlake.operators.json_events import parse_json_events
from predlake.operators.rows import name_columns
from predlake.plans import feeds
from predlake.sinks.parquet import VERSION, read_versions
from predlake.streaming.logger import scratch

SF = "/root/testdata/sf0.001"


def test_a_version_is_created_once(spark):
    catalog = scratch(spark, "catalog")
    a, b = S.PinnedSchema([("x", "bigint")], []), S.PinnedSchema([("x", "double")], [])
    assert S.lookup(spark, catalog, "s/one") is None
    assert S.create_version(spark, catalog, "s/one", 1, a) and not S.create_version(spark, catalog, "s/one", 1, b)
    assert S.lookup(spark, catalog, "s/one") == a
    # a second starter takes the first one's schema; registering goes on with the next version
    assert S.pin_first(spark, catalog, "s/one", b) == a
    assert S.register(spark, catalog, "s/one", a) == 1 and S.register(spark, catalog, "s/one", b) == 2
    assert S.lookup(spark, catalog, "s/one").version == 2 and S.lookup(spark, catalog, "s/one", 1) == a
    assert S.lookup(spark, catalog, "s") is None


def test_two_writers_of_a_version_lose_no_column(spark, monkeypatch):
    catalog = scratch(spark, "catalog")
    named = name_columns(parse_json_events(feeds.json_events(spark, SF)))
    real, other = S.create_version, S.PinnedSchema([("extra", "boolean")], [])

    def raced(spark, catalog, subject, version, schema):
        if version == 1:
            real(spark, catalog, subject, 1, other)
        return real(spark, catalog, subject, version, schema)
    monkeypatch.setattr(S, "create_version", raced)
    got = S.evolve(named, catalog, "s")
    assert got.version == 2 and [n for n, _ in got.inputs] == ["extra", "user_id", "k"]


@pytest.mark.parametrize("a,b,want", [
    ("bigint", "bigint", "bigint"), ("bigint", "double", "double"), ("void", "string", "string"), ("string", "bigint", None), ("boolean", "bigint", None),
    ("array<bigint>", "array<double>", "array<double>"), ("array<void>", "array<string>", "array<string>"), ("array<bigint>", "bigint", None),
    ("struct<a: bigint>", "struct<b: string, a: double>", "struct<`a`: double, `b`: string>"), ("struct<a: bigint>", "struct<a: string>", None)])
def test_types_join(a, b, want):
    assert S.join_types(a, b) == want and (S.join_types(b, a) is None) == (want is None)


TYPES = st.sampled_from(["void", "bigint", "double", "string", "boolean", "array<bigint>", "array<double>", "struct<`a`: bigint>", "struct<`a`: double, `b`: string>"])


@given(TYPES, TYPES, TYPES)
def test_the_join_is_a_least_upper_bound(spark, a, b, c):
    def join(x, y):
        return None if x is None or y is None else S.join_types(x, y)

    def holds(x):   # the same type whatever the order of struct fields
        return None if x is None else "".join(sorted(x))
    assert join(a, a) == a and holds(join(a, b)) == holds(join(b, a))
    assert holds(join(join(a, b), c)) == holds(join(a, join(b, c)))


def test_schemas_join_in_the_old_order_and_name_what_they_refuse():
    old = S.PinnedSchema([("x", "bigint"), ("t", "string")], [("y", "void")])
    new = S.PinnedSchema([("n", "string"), ("t", "bigint"), ("x", "double")], [("y", "boolean")])
    joined, refused = S.join_schemas(old, new)
    assert joined == S.PinnedSchema([("x", "double"), ("t", "string"), ("n", "string")], [("y", "boolean")]) and refused == ["t"]


def test_versions_are_read_in_the_latest_columns(spark):
    path = scratch(spark, "versions")
    one, two = S.PinnedSchema([("x", "bigint"), ("v", "void")], [], 1), S.PinnedSchema([("x", "double"), ("v", "boolean"), ("n", "string")], [], 2)
    three = S.PinnedSchema([*two.inputs, ("z", "bigint")], [], 3)
    spark.createDataFrame([("a_0", "t", 1, None)], one.struct_type()).write.parquet(f"{path}/{VERSION}=1")
    spark.createDataFrame([("b_0", "t", 1.5, True, "n")], two.struct_type()).write.parquet(f"{path}/{VERSION}=2")
    rows = sorted(tuple(r) for r in read_versions(spark, path, [one, two, three]).collect())
    assert rows == [("a_0", "t", 1.0, None, None, None, 1), ("b_0", "t", 1.5, True, "n", None, 2)]
    assert read_versions(spark, path + "-none", [one]).count() == 0
