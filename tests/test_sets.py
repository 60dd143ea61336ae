"""Sets of files: complete in any order and over several runs, overdue when their time is out."""

import time
from datetime import timedelta

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import ingest, sets

SCHEMA = "set string, name string, path string"


def _runs(spark, runs, wait=timedelta(days=3)):
    """What each run ends, from files that are named in rows of a stream."""
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    seen, per_run = set(), []
    for rows in runs:
        data = [(s, n, f"{s}/{n}/{i}") for i, (s, n) in enumerate(rows)]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        ended = sets.ended_sets(ingest.arriving_files(spark, folder, SCHEMA), ["dv", "risk"], wait)
        ingest.run_available(ended, checkpoint, ingest.replay_safe_files(out))
        try:
            now = {(r["set"], r["status"], tuple(r["names"])) for r in spark.read.parquet(out).collect()}
        except Exception:  # nothing has ended yet
            now = set()
        per_run.append(now - seen)
        time.sleep(2 if wait < timedelta(minutes=1) else 0)
        seen |= now
    return per_run


def test_files_in_any_order_over_several_runs(spark):
    got = _runs(spark, [
        [("a", "risk"), ("b", "dv"), (None, "dv"), ("c", "other")],
        [("b", "risk"), ("a", "risk")],
        [("a", "dv"), ("d", "dv"), ("d", "risk")],
    ])
    assert got == [set(), {("b", "complete", ("dv", "risk"))}, {("a", "complete", ("dv", "risk")), ("d", "complete", ("dv", "risk"))}]


def test_a_set_that_waits_too_long(spark):
    got = _runs(spark, [[("a", "risk")], [("b", "dv")], [("b", "risk"), ("a", "dv")]], timedelta(seconds=1))
    ended = set().union(*got)
    assert {("a", "overdue", ("risk",)), ("b", "complete", ("dv", "risk"))} <= ended
    assert ("a", "complete", ("dv", "risk")) not in ended


def test_complete_sets_are_loaded_together(spark, rows):
    folder, data, late, checkpoint = (scratch_path(spark, n) for n in ("in", "data", "late", "cp"))
    read = lambda s, paths: s.read.schema("v long").parquet(*paths).withColumn(
        "set", F.regexp_extract("_metadata.file_path", r"/(\w+)_\w+\.d/", 1)
    )
    for name in ("x_risk", "y_dv", "x_dv"):
        spark.range(3).selectExpr("id as v").coalesce(1).write.parquet(f"{folder}/{name}.d")
        names = sets.arriving_names(spark, folder, r"/(\w+)_(\w+)\.d/")
        ended = sets.ended_sets(names, ["dv", "risk"], timedelta(days=3))
        ingest.run_available(ended, checkpoint, sets.load_sets(read, data, late))
    assert rows(spark.read.parquet(data)) == sorted([(v, "x") for v in (0, 0, 1, 1, 2, 2)], key=repr)
