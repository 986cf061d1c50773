"""Every registered query against its DuckDB oracle (row count, columns, values) at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from predlake.plans import queries as Q
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
ORACLES = Q.ORACLES
QUERIES = Q.QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = digest(QUERIES[name](spark, SF).toPandas())
    want = digest(duck.execute(ORACLES[name]).fetchdf())
    assert got[0] == want[0] and got[1] == want[1]
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["model_name", "hour", "inferences", "datapoints"]
