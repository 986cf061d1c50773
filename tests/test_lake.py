"""Destinations and the lake: our own data source, compaction, replay."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from predlake.functions.shared_files import create_once, names_in
from predlake.operators.replay import replay
from predlake.operators.schema import PinnedSchema
from predlake.plans.spec import LoggerSpec, SpecError
from predlake.sinks import compact as C
from predlake.sinks import files as D
from predlake.sinks import parquet
from predlake.streaming import logger
from helpers import T0, envelopes_df



def scratch(spark, what):
    """A local path, as glob and open want it."""
    return logger.scratch(spark, what).removeprefix("file:")


SCHEMA = PinnedSchema([("x", "bigint")], [("y", "double")])


def rows(spark, lo, hi, parts=3):
    return spark.range(lo, hi, 1, parts).select(F.concat("id", F.lit("_0")).alias("id"), F.lit("t").alias("occurred_at"),
                                                F.col("id").alias("x"), (F.col("id") / 2).alias("y"))


def ids(df):
    return sorted(r.x for r in df.select("x").collect())


def test_files_are_seen_by_batch_and_a_repeated_batch_replaces_them(spark):
    url = scratch(spark, "files")
    D.write_batch(rows(spark, 0, 10), {"url": url, "batch": 0}, "a")
    D.write_batch(rows(spark, 10, 20), {"url": url, "batch": 1}, "a")
    D.write_batch(rows(spark, 10, 22, 5), {"url": url, "batch": 1}, "a")      # the stream came back
    got = D.read_committed(spark, f"{url}/a", SCHEMA.struct_type())
    assert ids(got) == list(range(22)) and got.where("y = x / 2").count() == 22
    named = {n for m in glob.glob(f"{url}/a/manifests/[0-9]*") for n in json.load(open(m))["files"]}
    assert {os.path.relpath(p, f"{url}/a") for p in glob.glob(f"{url}/a/batch=*/*")} == named
    assert D.read_committed(spark, f"{url}/none", SCHEMA.struct_type()).count() == 0


def test_a_failed_task_leaves_nothing(spark):
    url = scratch(spark, "files")
    bad = rows(spark, 0, 4000, 4).withColumn("y", F.when(F.col("x") == 3999, F.raise_error(F.lit("broken"))).otherwise(F.col("y")))
    with pytest.raises(Exception, match="broken"):
        D.write_batch(bad, {"url": url, "batch": 0}, "a")
    assert not glob.glob(f"{url}/a/manifests/*") and not glob.glob(f"{url}/a/batch=*/*")
    D.write_batch(rows(spark, 0, 4), {"url": url, "batch": 0}, "a")
    assert ids(D.read_committed(spark, f"{url}/a", SCHEMA.struct_type())) == [0, 1, 2, 3]


def test_a_killed_task_that_is_late_leaves_nothing(tmp_path):
    import threading
    os.makedirs(f"{tmp_path}/a/batch=7")
    late = threading.Timer(0.4, lambda: open(f"{tmp_path}/a/batch=7/late.json", "w").close())
    late.start()
    D.FilesWriter(f"{tmp_path}/a", "7").settle()
    late.join()
    assert not glob.glob(f"{tmp_path}/a/batch=*/*")


def test_snapshots_around_a_compaction(spark, monkeypatch):
    url = scratch(spark, "lake")
    path, struct = f"{url}/a", SCHEMA.struct_type()
    assert C.compact(spark, path, struct) == 0 and C.read_snapshot(spark, path, struct).count() == 0
    for b in range(4):
        parquet.write_batch(rows(spark, 10 * b, 10 * b + 10), {"url": url, "batch": b}, "a")
    assert C.compact(spark, path, struct) == 3                               # the newest batch may still be written again
    assert ids(C.read_snapshot(spark, path, struct)) == list(range(40))
    parquet.write_batch(rows(spark, 30, 45), {"url": url, "batch": 3}, "a")   # and it is
    parquet.write_batch(rows(spark, 45, 50), {"url": url, "batch": 4}, "a")
    assert ids(C.read_snapshot(spark, path, struct)) == list(range(50))
    before = len(glob.glob(f"{path}/{parquet.BATCH}=*/*.parquet"))
    assert C.compact(spark, path, struct) == 1
    assert C.vacuum(spark, path) == 4 and ids(C.read_snapshot(spark, path, struct)) == list(range(50))
    after = len([f for folder in C.snapshot_folders(spark, path) for f in glob.glob(f"{folder}/*.parquet")])
    assert after < before / 2
    # a folder that no writer has finished is not read
    os.makedirs(f"{path}/{parquet.BATCH}=9")
    assert ids(C.read_snapshot(spark, path, struct)) == list(range(50))


def test_of_two_compactions_one_publishes(spark, monkeypatch):
    url = scratch(spark, "lake")
    path, struct = f"{url}/a", SCHEMA.struct_type()
    for b in range(3):
        parquet.write_batch(rows(spark, 10 * b, 10 * b + 10), {"url": url, "batch": b}, "a")
    real = C.create_once

    def raced(spark, folder, name, text):
        monkeypatch.setattr(C, "create_once", real)
        assert C.compact(spark, path, struct) == 2
        return real(spark, folder, name, text)
    monkeypatch.setattr(C, "create_once", raced)
    assert C.compact(spark, path, struct) == 0
    assert ids(C.read_snapshot(spark, path, struct)) == list(range(30)) and len(glob.glob(f"{path}/compacted/*")) == 1


def test_a_file_is_created_once(spark):
    folder = scratch(spark, "once")
    assert create_once(spark, folder, "a", "one") and not create_once(spark, folder, "a", "two")
    assert open(f"{folder}/a").read() == "one" and names_in(spark, folder) == {"a": 3}


def test_replay_logs_each_message_once_and_keeps_what_stays_bad(spark):
    url = scratch(spark, "replay")
    good = '{"id":"%d","inputs":[{"x":1}],"outputs":[{"y":0.5}]}'
    values = [(good % 1 + "#", 1), (good % 2 + "#", 2), ("{#", 3), ("{", 4), (good % 1 + "#", 1), (good % 5 + "#", None)]
    env = envelopes_df(spark, [(None, v, [], "t", 0, off, T0) for v, off in values])
    refused = env.select(F.lit("malformed_body").alias("reason"), "topic", "partition", "offset", "timestamp", F.lit(None).cast("string").alias("event_id"), "value")
    refused.write.parquet(f"{url}/q")
    spec = LoggerSpec.from_dict({"name": "a", "topic": "t", "events": {"type": "json"}, "destination": {"type": "parquet", "config": {"url": url}}})
    rules = {"malformed_body": F.regexp_replace("value", "#$", "")}
    assert replay(spark, spec, f"{url}/q", f"{url}/ledger", rules, SCHEMA) == 4
    assert replay(spark, spec, f"{url}/q", f"{url}/ledger", rules, SCHEMA) == 0
    assert sorted(r.id for r in spark.read.parquet(f"{url}/a").collect()) == ["1_0", "2_0", "5_0"]
    assert sorted((r.outcome, r.offset) for r in spark.read.parquet(f"{url}/ledger").collect() if r.offset) == [("logged", 1), ("logged", 2), ("malformed_body", 3)]
    assert replay(spark, spec, f"{url}/q", f"{url}/ledger", {"malformed_body": F.lit(good % 4)}, SCHEMA) == 1   # another rule, for what is left
    paired = LoggerSpec.from_dict({"name": "a", "topic": "t", "events": {"type": "kserve"}, "destination": {"type": "parquet", "config": {"url": url}}})
    with pytest.raises(SpecError):
        replay(spark, paired, f"{url}/q", f"{url}/ledger", rules, SCHEMA)
