"""What queries persist and stage does not outlive its use."""

import os
import subprocess
import sys

from predlake import session
from predlake.plans import feeds
from predlake.plans.logger import fan_out
from predlake.plans.queries import FAN_OUT_SPECS, QUERIES
from predlake.plans.spec import LoggerSpec

SF = "/root/testdata/sf0.001"
ROOT = __file__.rsplit("/tests/", 1)[0]


def persisted(spark):
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_fan_out_lets_go_of_what_its_loggers_share(spark):
    session.release_kept()
    before = persisted(spark)
    out = fan_out([LoggerSpec.from_dict(d) for d in FAN_OUT_SPECS], feeds.kserve_pairs(spark, SF))
    n = out.rows.count()
    assert n > 0 and persisted(spark) > before
    out.release()
    assert persisted(spark) == before and out.rows.count() == n


def test_a_query_releases_what_the_one_before_it_kept(spark):
    session.release_kept()
    before = persisted(spark)
    first = QUERIES["json_flatten"](spark, SF)
    rows = first.count()
    assert persisted(spark) > before
    QUERIES["entry_model_hours"](spark, SF).count()
    assert persisted(spark) == before and first.count() == rows


def test_scratch_folders_are_deleted_when_the_process_ends(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from predlake.session import local_session, scratch_folder\n"
            f"s = local_session(2, 2, checkpoint={str(tmp_path)!r})\n"
            "p = scratch_folder(s, 'run'); s.range(5).write.parquet(p); print(s.read.parquet(p).count(), p)\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    n, path = out.stdout.split()
    assert n == "5" and path.removeprefix("file:").startswith(str(tmp_path)) and not os.path.exists(path.removeprefix("file:"))
