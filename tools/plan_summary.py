"""Per query: exchanges, scans and the columns each scan reads, from the initial plan of the query's frame.

Usage: python tools/plan_summary.py [sf_dir] [query ...]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from predlake.plans.queries import QUERIES  # noqa: E402
from predlake.session import local_session  # noqa: E402

SKIP = {"schema_infer"}   # and the stream queries, whose frames read what a stream has written


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    print("| query | exchanges (hash / other) | reused | scans | columns read |")
    print("| --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SKIP or name.startswith("stream_") or (only and name not in only):
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops = [re.sub(r"^[\s:+\-*()0-9]*", "", line) for line in plan.split("\n")]
        hashed = sum(o.startswith("Exchange hashpartitioning") for o in ops)
        other = sum(o.startswith("Exchange ") for o in ops) - hashed
        reused = sum(o.startswith("ReusedExchange") for o in ops)
        scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/([a-z]+)\.parquet\]", plan)
        cols = "; ".join(sorted({f"{t}: " + ",".join(re.sub(r"#\d+L?", "", c) for c in cs.split(","))
                                 for cs, t in scans}))
        print(f"| {name} | {hashed} / {other} | {reused} | {len(scans)} | {cols} |", flush=True)


if __name__ == "__main__":
    main()
