"""P9-P12, J2, C1-C4 on small inferences: names, clashes, zip, schema catalog."""

from helpers import pair
from predlake.operators.correlate import kserve_inferences
from predlake.operators.rows import name_columns
from predlake.operators.schema import PinnedSchema, lookup, register
from predlake.plans.logger import datapoints


def _logged(spark, req, resp, **kw):
    return datapoints(kserve_inferences(pair(spark, req, resp)), **kw)


def test_default_names_and_zip_truncates(spark):
    logged = _logged(spark, {"instances": [[1, 2], [3, 4], [5, 6]]}, {"predictions": [0.5, 0.7]})
    assert [n for n, _ in logged.schema.inputs] == ["X0", "X1"]
    assert [n for n, _ in logged.schema.outputs] == ["Y0"]
    rows = sorted(tuple(r) for r in logged.good.select("id", "X0", "X1", "Y0").collect())
    assert rows == [("r1_0", 1, 2, 0.5), ("r1_1", 3, 4, 0.7)]


def test_strict_zip_quarantines_unequal_counts(spark):
    logged = _logged(spark, {"instances": [[1], [2]]}, {"predictions": [1]}, strict=True)
    assert logged.good.count() == 0
    assert [r.reason for r in logged.quarantine.collect()] == ["row_count_mismatch"]


def test_name_clash_output_wins_at_input_position(spark):
    req = {"instances": [{"a": 1, "score": 10}]}
    resp = {"predictions": [{"score": 99, "b": 2}]}
    logged = _logged(spark, req, resp)
    g = logged.good
    assert g.columns == ["id", "occurred_at", "a", "score", "b"]
    assert tuple(g.select("a", "score", "b").first()) == (1, 99, 2)


def test_reserved_names_refused(spark):
    logged = _logged(spark, {"instances": [{"id": 1}]}, {"predictions": [1]},
                     schema=PinnedSchema([("id", "bigint")], [("Y0", "bigint")]))
    assert [r.reason for r in logged.quarantine.collect()] == ["reserved_column_name"]


def test_override_length_checked(spark):
    inf = kserve_inferences(pair(spark, {"instances": [[1, 2]]}, {"predictions": [1]}))
    named = name_columns(inf, input_names=["only_one"])
    assert [r._reason for r in named.collect()] == ["column_count_mismatch"]


def test_catalog_register_lookup_and_reuse(spark, tmp_path):
    cat = str(tmp_path / "catalog")
    s1 = PinnedSchema([("X0", "bigint")], [("Y0", "double")])
    assert register(spark, cat, "m-value", s1) == 1
    assert register(spark, cat, "m-value", s1) == 1          # identical: same version
    s2 = PinnedSchema([("X0", "bigint"), ("X1", "bigint")], [("Y0", "double")])
    assert register(spark, cat, "m-value", s2) == 2
    assert lookup(spark, cat, "m-value") == s2
    # a registered schema is used as is (no inference): X1 missing -> NULL
    logged = _logged(spark, {"instances": [[7]]}, {"predictions": [0.5]}, catalog=cat, subject="m-value")
    assert logged.cached is None and logged.schema == s2
    assert tuple(logged.good.select("X0", "X1", "Y0").first()) == (7, None, 0.5)
