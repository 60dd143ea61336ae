from pyspark.sql import functions as F

from millrace.session import scratch_path, scratch_schema
from millrace.streaming import ingest

SCHEMA = "k int, t int, v string"


def _land(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_each_file_is_processed_once(spark, rows):
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    _land(spark, folder, [(1, 1, "a")])
    stream = ingest.arriving_files(spark, folder, SCHEMA)
    for _ in range(2):
        ingest.run_available(stream, checkpoint, ingest.replay_safe_files(target))
    _land(spark, folder, [(2, 1, "b")])
    ingest.run_available(stream, checkpoint, ingest.replay_safe_files(target))
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "b")]


def test_a_repeated_batch_replaces_itself(spark):
    target = scratch_path(spark, "out")
    write = ingest.replay_safe_files(target)
    for _ in range(2):
        write(spark.range(3), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(target).count() == 5


def test_only_new_keys_are_appended(spark, rows):
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    write = ingest.append_new_keys(target, ["k"], SCHEMA)
    _land(spark, folder, [(1, 1, "a"), (1, 1, "a")])
    stream = ingest.arriving_files(spark, folder, SCHEMA)
    ingest.run_available(stream, checkpoint, write)
    _land(spark, folder, [(1, 2, "again"), (2, 2, "b")])
    ingest.run_available(stream, checkpoint, write)
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "b")]


def test_stored_keys_stay_off_the_driver(spark, rows, monkeypatch):
    """However few keys are stored, no batch broadcasts them: the batches would add up. A null key stays new."""
    target, plans = scratch_path(spark, "out"), []
    plain = ingest.replay_safe_files

    def watched(path):
        def write(batch, batch_id):
            batch.collect()
            plans.append(batch._jdf.queryExecution().executedPlan().toString())
            plain(path)(batch, batch_id)

        return write

    monkeypatch.setattr(ingest, "replay_safe_files", watched)
    write = ingest.append_new_keys(target, ["k"], SCHEMA)
    batches = [[(1, 1, "a"), (None, 1, "n")], [(1, 2, "again"), (2, 2, "b"), (None, 2, "n")], [(3, 3, "c"), (2, 3, "again")]]
    for batch_id, batch in enumerate(batches):
        write(spark.createDataFrame(batch, SCHEMA), batch_id)
    assert [plan.count("Broadcast") for plan in plans] == [0, 0, 0]
    assert all("LeftAnti" in plan for plan in plans[1:])
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (None, "n")]


def test_merge_latest(spark, rows):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    table = f"{scratch_schema(spark, 'latest')}.t"
    write = ingest.merge_latest(table, ["k"], ["t", "v"])
    _land(spark, folder, [(1, 1, "a"), (1, 2, "b"), (2, 5, "c")])
    stream = ingest.arriving_files(spark, folder, SCHEMA)
    ingest.run_available(stream, checkpoint, write)
    _land(spark, folder, [(1, 3, "d"), (2, 4, "late")])
    ingest.run_available(stream, checkpoint, write)
    assert rows(spark.table(table)) == [(1, 3, "d"), (2, 5, "c")]


def test_merge_after_a_swap_that_was_cut_short(spark, rows):
    table = f"{scratch_schema(spark, 'cut')}.t"
    write = ingest.merge_latest(table, ["k"], ["t"])
    write(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA), 0)
    # The driver died after the old table had given up its name.
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    spark.range(1).write.saveAsTable(f"{table}__swap")
    write(spark.createDataFrame([(1, 2, "c")], SCHEMA), 1)
    assert rows(spark.table(table)) == [(1, 2, "c"), (2, 1, "b")]
    assert not spark.catalog.tableExists(f"{table}__old")


def test_merge_latest_files(spark, rows):
    folder, checkpoint, table = (scratch_path(spark, n) for n in ("in", "cp", "out"))
    write = ingest.merge_latest_files(table, ["k"], ["t", "v"], 4)
    _land(spark, folder, [(1, 1, "a"), (1, 2, "b"), (2, 5, "c")])
    stream = ingest.arriving_files(spark, folder, SCHEMA)
    ingest.run_available(stream, checkpoint, write)
    _land(spark, folder, [(1, 3, "d"), (2, 4, "late"), (3, 1, "e")])
    ingest.run_available(stream, checkpoint, write)
    assert rows(spark.read.parquet(table).select("k", "t", "v")) == [(1, 3, "d"), (2, 5, "c"), (3, 1, "e")]


def test_tumbling_totals_drop_late_rows(spark, rows):
    schema = "ts timestamp, kind string, value int"
    folder, checkpoint, target = (scratch_path(spark, n) for n in ("in", "cp", "out"))

    def land(*data):
        df = spark.createDataFrame(data, "ts string, kind string, value int").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = ingest.arriving_files(spark, folder, schema)
        totals = ingest.tumbling_totals(stream, "ts", ["kind"], "value", "1 hour", "10 minutes")
        query = (
            totals.writeStream.format("parquet").outputMode("append").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    land(("2024-01-01 00:10:00", "a", 1), ("2024-01-01 00:20:00", "a", 2))
    run()
    land(("2024-01-01 02:00:00", "a", 5))
    run()
    land(("2024-01-01 00:30:00", "a", 100), ("2024-01-01 04:00:00", "a", 7))
    run()
    got = spark.read.parquet(target).select(F.date_format("window_start", "HH"), "events", "total")
    assert rows(got) == [("00", 2, 3), ("02", 1, 5)]
