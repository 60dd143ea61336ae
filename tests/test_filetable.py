"""Merges into a table of files: rows as by delete and insert, and files without a merged key stay as they are."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.upsert import delete_insert
from millrace.session import scratch_path
from millrace.sinks import filetable

SCHEMA = "a int, b string, v string"


def _files(spark, place):
    meta = F.col("_metadata")
    rows = spark.read.parquet(f"{place}/data").select(meta["file_name"], meta["file_modification_time"]).distinct().collect()
    return {tuple(r) for r in rows}


def test_only_files_with_a_merged_key_are_replaced(spark, rows):
    place = scratch_path(spark, "files")
    first = spark.range(1000).selectExpr("int(id) as a", "'k' as b", "string(id) as v")
    assert filetable.merge_files(first, place, ["a", "b"], 10) == []
    before = _files(spark, place)
    assert len(before) == 10
    stage = spark.createDataFrame([(5, "k", "new"), (5, "k", "twice"), (7, "other", "added"), (2000, "k", "end"), (None, "k", "null")], SCHEMA)
    replaced = filetable.merge_files(stage, place, ["a", "b"], 2)
    assert len(replaced) == 1 and before <= _files(spark, place) and filetable.replaced_files(spark, place) == replaced
    want = rows(delete_insert(first, stage, ["a", "b"]))
    assert rows(filetable.read_files_table(spark, place)) == want
    # A null key matches nothing, so a repeated stage adds that row again and replaces the others by themselves.
    filetable.merge_files(stage, place, ["a", "b"], 2)
    assert rows(filetable.read_files_table(spark, place)) == sorted([*want, (None, "k", "null")], key=repr)


def test_files_of_a_writer_that_died_are_not_read(spark, rows):
    place = scratch_path(spark, "files")
    stage = spark.createDataFrame([(1, "x", "v")], SCHEMA)
    filetable.merge_files(stage, place, ["a"], 1)
    stage.write.parquet(f"{place}/data/commit=dead")
    assert rows(filetable.read_files_table(spark, place)) == [(1, "x", "v")]
    assert filetable.merge_files(stage.where("false"), place, ["a"], 1) == []
    with pytest.raises(ValueError, match="columns"):
        filetable.merge_files(stage.drop("v"), place, ["a"], 1)


def test_empty_and_missing_tables(spark, rows):
    place = scratch_path(spark, "files")
    with pytest.raises(ValueError, match="no table"):
        filetable.read_files_table(spark, place)
    stage = spark.createDataFrame([(1, "x", "v")], SCHEMA)
    filetable.merge_files(stage.where("false"), place, ["a"])
    assert rows(filetable.read_files_table(spark, place)) == []
    filetable.merge_files(stage, place, ["a"])
    assert rows(filetable.read_files_table(spark, place)) == [(1, "x", "v")]


def test_hot_key_lies_in_several_files(spark):
    place = scratch_path(spark, "files")
    filetable.merge_files(spark.range(4000).selectExpr("1 as a", "string(id) as v"), place, ["a"], 4)
    assert len(_files(spark, place)) == 4
