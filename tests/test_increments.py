import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import incremental as inc
from millrace.operators import ranges, upsert
from millrace.operators.pivots import pivot_attributes
from millrace.session import scratch_path, scratch_schema


def _df(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_null_keys(spark, rows):
    df = _df(spark, [(1, "a"), (None, "b"), (2, "c")])
    known = _df(spark, [(1, "x"), (None, "y")])
    assert rows(inc.not_yet_loaded(df, known, ["k"])) == [(2, "c"), (None, "b")]
    assert rows(inc.not_in(df, known, "k")) == [(2, "c")]
    assert rows(inc.not_in(df, known, "k", null_rejects_all=True)) == []
    assert rows(inc.not_in(df, known.where("k = 1"), "k", null_rejects_all=True)) == [(2, "c")]
    assert rows(inc.already_stored(df, known, "k")) == [(1, "a")]


def test_copies_are_kept(spark, rows):
    df = _df(spark, [(1, "a"), (1, "a"), (2, "b"), (2, "b")])
    known = _df(spark, [(2, "x"), (2, "y")])
    assert rows(inc.not_yet_loaded(df, known, ["k"])) == [(1, "a"), (1, "a")]


def test_watermark(spark, rows):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, i)) for i in (1, 2, 3)], "k int, ts timestamp_ntz")
    stored = df.where("k <= 2")
    mark = inc.high_watermark(stored, "ts")
    assert mark == dt.datetime(2024, 1, 2)
    assert inc.count_newer(df, "ts", mark) == 1
    assert inc.newer_than(df, "ts", mark, overlap=True).count() == 2
    assert inc.high_watermark(df.limit(0), "ts") is None
    assert inc.newer_than(df, "ts", None).count() == 3
    plan = inc.newer_than(df, "ts", mark)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan
    # The overlap with delete and insert picks up a late row that ties with the mark.
    late = df.unionByName(spark.createDataFrame([(9, mark)], df.schema))
    again = inc.newer_than(late, "ts", mark, overlap=True)
    assert rows(upsert.delete_insert(stored, again, ["k"]).select("k")) == [(1,), (2,), (3,), (9,)]


def test_day_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path).where(inc.on_day(F.col("ts"), dt.date(2024, 1, 2)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert df.count() == 1


def test_keep_latest(spark, rows):
    df = _df(spark, [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f")], "k int, t int, v string")
    assert rows(upsert.keep_latest(df, ["k"], ["t", "v"])) == [(1, 2, "c"), (2, 1, "d"), (None, 2, "f")]


def test_keep_latest_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    plan = upsert.keep_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_delete_insert(spark, rows):
    target = _df(spark, [(1, "old"), (2, "old"), (None, "old")])
    stage = _df(spark, [(1, "new"), (1, "new"), (None, "new"), (3, "new")])
    once = upsert.delete_insert(target, stage, ["k"])
    assert rows(once) == sorted(
        [(1, "new"), (1, "new"), (2, "old"), (3, "new"), (None, "old"), (None, "new")], key=repr
    )
    keyed = stage.where("k is not null")
    twice = upsert.delete_insert(upsert.delete_insert(target, keyed, ["k"]), keyed, ["k"])
    assert rows(twice) == rows(upsert.delete_insert(target, keyed, ["k"]))


def test_delete_insert_partitions_leaves_other_partitions(spark, rows):
    path = scratch_path(spark, "partitioned")
    target = _df(spark, [(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")], "k int, v string, day string")
    target.write.partitionBy("day").parquet(path)
    stage = _df(spark, [(1, "new", "d1"), (4, "new", "d3")], "k int, v string, day string")
    upsert.delete_insert_partitions(spark, path, stage, ["k", "day"], "day")
    got = rows(spark.read.schema(stage.schema).parquet(path))
    assert got == [(1, "new", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "new", "d3")]


def test_rows_without_a_partition_value_stay(spark, rows):
    schema, path = "k int, v string, day string", scratch_path(spark, "partitioned")
    _df(spark, [(1, "a", None), (2, "b", "d1"), (3, "c", None)], schema).write.partitionBy("day").parquet(path)
    stage = _df(spark, [(1, "new", None), (2, "new", "d1")], schema)
    upsert.delete_insert_partitions(spark, path, stage, ["k", "day"], "day")
    got = rows(spark.read.schema(schema).parquet(path))
    # A null key matches nothing, so both rows of key 1 stay.
    assert got == sorted([(1, "a", None), (1, "new", None), (2, "new", "d1"), (3, "c", None)], key=repr)


def test_merge_latest_buckets_touches_only_its_buckets(spark, rows):
    from pathlib import Path

    path, keys, by = scratch_path(spark, "buckets"), ["k"], ["t"]
    schema = "k int, t int, v string"
    old = _df(spark, [(k, 1, "old") for k in range(40)], schema)
    upsert.write_partitions(upsert.with_bucket(old, keys, 8), path, upsert.BUCKET)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    fresh = _df(spark, [(1, 2, "new"), (2, 0, "late"), (1, 1, "older")], schema)
    for _ in range(2):
        upsert.merge_latest_buckets(spark, path, fresh, keys, by, 8)
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {k: "new" if k == 1 else "old" for k in range(40)}
    untouched = [p for p in before if p.exists()]
    assert len(untouched) >= len(before) - 2


def test_swap_does_not_trust_a_stale_side_table(spark, rows):
    schema = scratch_schema(spark, "swap")
    _df(spark, [(9, "stale")]).write.saveAsTable(f"{schema}.t__swap")
    _df(spark, [(1, "a")]).write.saveAsTable(f"{schema}.t")
    upsert.swap_table(spark.table(f"{schema}.t").withColumn("v", F.lit("b")), f"{schema}.t")
    assert rows(spark.table(f"{schema}.t")) == [(1, "b")]
    assert not spark.catalog.tableExists(f"{schema}.t__swap")


def test_snapshot(spark, rows):
    schema = "k int, status string, at int"
    empty = _df(spark, [], schema + ", valid_from int, valid_to int")
    first = upsert.snapshot(empty, _df(spark, [(1, "new", 10), (2, "new", 10)], schema), "k", "at")
    assert rows(first) == [(1, "new", 10, 10, None), (2, "new", 10, 10, None)]
    now = _df(spark, [(1, "done", 20), (3, "new", 20)], schema)
    second = upsert.snapshot(first, now, "k", "at")
    expected = sorted(
        [(1, "new", 10, 10, 20), (1, "done", 20, 20, None), (2, "new", 10, 10, None), (3, "new", 20, 20, None)], key=repr
    )
    assert rows(second) == expected
    assert rows(upsert.snapshot(second, now, "k", "at")) == expected


def test_pivot_attributes(spark, rows):
    df = _df(spark, [(1, "sin", "9"), (1, "suffix", "JR"), (1, "sin", "8"), (2, "other", "x")], "id int, key string, value string")
    got = pivot_attributes(df, "id", "key", "value", {"sin": "sin", "suffix": "suffix"})
    assert rows(got) == [(1, "9", "JR"), (2, None, None)]


def _hot_series(n=4000):
    generator = random.Random(7)
    out = []
    for i in range(n):
        key = generator.choice([1, 1, 1, None, generator.randrange(2, 40)])
        out.append((key, generator.randrange(0, n), i, generator.randrange(-50, 50)))
    return out


def _in_series_order(data):
    return sorted(data, key=lambda r: (r[0] or 0, r[1], r[2]))


def test_running_total_of_a_hot_key(spark, rows):
    data = _hot_series()
    df = spark.createDataFrame(data, "k int, t int, id int, v int").repartition(5)
    ordered = ranges.in_order(df, ["k"], ["t", "id"], ranges=8)
    got = ranges.running_total_before(ordered, ["k"], F.col("v"), "before").select("k", "id", "before")
    expected, totals = [], {}
    for k, _, i, v in _in_series_order(data):
        expected.append((k, i, totals.get(k, 0)))
        totals[k] = totals.get(k, 0) + v
    assert rows(got) == sorted(expected, key=repr)
    # Half of all rows share a key, yet no range holds more than a fair part.
    biggest = ordered.groupBy("k", "chunk").count().agg(F.max("count")).first()[0]
    assert biggest < len(data) / 4


def test_next_value_across_ranges(spark, rows):
    data = _hot_series(1000)
    df = spark.createDataFrame(data, "k int, t int, id int, v int")
    ordered = ranges.in_order(df, ["k"], ["t", "id"], ranges=6)
    got = ranges.next_in_order(ordered, ["k"], "id", "next").select("k", "id", "next")
    series = {}
    for k, _, i, _ in _in_series_order(data):
        series.setdefault(k, []).append(i)
    expected = [(k, i, after) for k, ids in series.items() for i, after in zip(ids, [*ids[1:], None])]
    assert rows(got) == sorted(expected, key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(-1000, 1000), max_size=60))
def test_row_id_counts_in_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r["v"]: r["id"] for r in ranges.with_row_id(df, ["v"], ranges=5).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values), start=1)}


def test_hot_key_is_split_by_the_adaptive_join(spark):
    saved = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name, None) for name in saved}
    try:
        for name, value in saved.items():
            spark.conf.set(name, value)
        hot = "case when id % 3 = 0 then 7 else id % 5000 end as k"
        left = spark.range(0, 300000, 1, 8).selectExpr(hot, "md5(cast(id as string)) as v")
        right = spark.range(0, 3000, 1, 4).selectExpr("id % 1000 + 10 as k")
        for df in (
            inc.not_yet_loaded(left, right, ["k"]),
            inc.already_stored(left, right.union(right.selectExpr("7L as k")), "k"),
            upsert.delete_insert(left, right.selectExpr("k", "'x' as v"), ["k"]),
        ):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
