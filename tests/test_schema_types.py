"""Column names that look like types, nested names, mixed cells, names that differ by case."""

import json

from helpers import T0, envelopes_df
from predlake.operators.json_events import parse_json_events
from predlake.operators.schema import logged_type, object_fields
from predlake.plans.logger import datapoints


def logged(spark, *inputs):
    rows = [(None, json.dumps({"id": str(i), "inputs": [x], "outputs": [{"y": 1}]}), [], "t", 0, i, T0) for i, x in enumerate(inputs)]
    return datapoints(parse_json_events(envelopes_df(spark, rows)))


def test_type_strings():
    text = "OBJECT<INT: ARRAY<DECIMAL(3,1)>, `p-q`: ARRAY<OBJECT<`a b`: VOID, VOID: ARRAY<BIGINT>>>, m: ARRAY<VARIANT>, `x``y`: ARRAY<STRING>>"
    assert object_fields(text) == {"INT": "double", "p-q": "struct<`a b`: string, `VOID`: array<bigint>>", "m": "mixed", "x`y": "string"}
    assert logged_type("ARRAY<ARRAY<FLOAT>>") == "array<array<double>>" and logged_type("OBJECT<>") == "string"


def test_names_like_types_and_nested_names(spark):
    out = logged(spark, {"INT": 1, "VOID": 2.5, "n": {"p-q": [1], "a:b, c": "x"}}, {"INT": 3, "VOID": 4, "n": {"p-q": [2], "a:b, c": "y"}})
    assert out.schema.inputs == [("INT", "bigint"), ("VOID", "double"), ("n", "struct<`a:b, c`: string, `p-q`: array<bigint>>")]
    rows = out.good.orderBy("id").collect()
    assert [(r["INT"], r["VOID"], r["n"]["p-q"]) for r in rows] == [(1, 2.5, [1]), (3, 4.0, [2])]


def test_one_text_cell_does_not_change_a_column(spark):
    out = logged(spark, {"a": None}, {"a": 1}, {"a": "oops"}, {"a": 2})
    assert out.schema.inputs == [("a", "bigint")]
    assert sorted((r._reason or "", r.a) for r in out.rows.collect() if r._reason or r.a) == [("", 1), ("", 2), ("type_mismatch", None)]
    assert logged(spark, {"a": 1}, {"a": 1.5}, {"a": "oops"}).schema.inputs == [("a", "double")]


def test_names_that_differ_by_case_are_refused(spark):
    out = logged(spark, {"a": 1, "A": 2}, {"a": 3})
    assert {r._reason for r in out.rows.collect()} == {"names_differ_by_case", None}
    assert out.schema.inputs == [("a", "bigint")]
