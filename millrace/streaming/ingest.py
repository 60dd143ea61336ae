"""Incremental ingest with Structured Streaming.

The checkpoint of a query is what remembers which files were processed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.incremental import not_yet_loaded
from millrace.operators.upsert import keep_latest, merge_latest_buckets, swap_table, union_all
from millrace.sinks.tables import restore_table

BatchWriter = Callable[[DataFrame, int], None]


def run_available(stream: DataFrame, checkpoint: str, write: BatchWriter) -> StreamingQuery:
    """Process everything that has arrived since the last run, once, and stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def arriving_files(
    spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files that land in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def replay_safe_files(path: str) -> BatchWriter:
    """Write each batch as its own partition, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def append_new_keys(path: str, keys: Sequence[str], schema: str) -> BatchWriter:
    """Like `replay_safe_files`, for rows whose key tuple was not stored by an earlier batch.

    The stored keys meet the batch by a shuffle: a broadcast would take all of them through the driver once a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(list(keys))
        if batch_id > 0:
            stored = spark.read.schema(f"{schema}, batch_id int").parquet(path)
            fresh = not_yet_loaded(fresh, stored.where(F.col("batch_id") < batch_id).hint("merge"), keys)
        replay_safe_files(path)(fresh, batch_id)

    return write


def merge_latest(table: str, keys: Sequence[str], latest_by: Sequence[str]) -> BatchWriter:
    """Merge each batch into a table that keeps the latest row per key.

    Repeating a batch changes nothing, and the swap never reads what it drops.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = keep_latest(batch, keys, latest_by)
        if restore_table(spark, table):
            fresh = keep_latest(union_all(fresh, spark.table(table)), keys, latest_by)
        swap_table(fresh, table)

    return write


def merge_latest_files(
    path: str, keys: Sequence[str], latest_by: Sequence[str], buckets: int
) -> BatchWriter:
    """Like `merge_latest`, into a table by key bucket: a batch rewrites its own buckets only."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        merge_latest_buckets(batch.sparkSession, path, batch, keys, latest_by, buckets)

    return write


def tumbling_totals(
    stream: DataFrame, time: str, keys: Sequence[str], value: str, width: str = "1 day", late: str = "1 hour"
) -> DataFrame:
    """Count and sum per key and time window; rows later than `late` are dropped."""
    window = F.window(time, width)
    return (
        stream.withWatermark(time, late)
        .groupBy(window.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), *keys, "events", "total")
    )
