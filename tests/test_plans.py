"""Plan properties the design relies on."""

import re

from pyspark.sql import functions as F

from predlake.functions.barrier import where
from predlake.operators.correlate import kserve_inferences
from predlake.operators.envelope import classify
from predlake.plans import feeds

SF = "/root/testdata/sf0.001"


def _ops(plan: str) -> list[str]:
    plan = plan.split("== Initial Plan ==")[0]
    return [re.sub(r"^[\s:+\-*()0-9]*", "", line) for line in plan.split("\n")]


def test_reason_filter_stays_above_the_parse(spark):
    env = feeds.kserve_pairs(spark, SF)
    good = where(classify(env), F.col("_reason").isNull())
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if re.search(r"(^|[+:\- ])Filter ", line)]
    assert filters and not any("from_json" in f for f in filters)


def test_pairs_and_quarantine_share_one_exchange(spark):
    inf = kserve_inferences(feeds.broken_pairs(spark, SF))
    ops = _ops(inf._jdf.queryExecution().executedPlan().toString())
    assert sum(o.startswith("Exchange hashpartitioning") for o in ops) == 1
    assert sum(o.startswith("FileScan parquet") for o in ops) == 1


def test_a_body_is_parsed_once(spark):
    plan = kserve_inferences(feeds.kserve_pairs(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("end of body") > 0
    body = [line for line in plan.split("\n") if "AS body#" in line]
    assert len(body) == 1 and body[0].count("from_json(StructField(body") == 1


def test_a_reader_of_headers_and_times_has_no_bodies_made(spark):
    for feed in (feeds.kserve_pairs, feeds.refused_pairs, feeds.v1_orders, feeds.v2_orders):
        plan = feed(spark, SF).select("headers", "timestamp")._jdf.queryExecution().optimizedPlan().toString()
        assert "to_json" not in plan, feed.__name__
    assert "$.model_name" not in feeds.damaged_events(spark, SF)._jdf.queryExecution().optimizedPlan().toString()   # the type is a column of the table
