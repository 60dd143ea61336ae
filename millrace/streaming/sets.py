"""Sets of files that are processed together, once all of them have arrived.

State per set holds the names and paths that have come, so files may come in any order and over several runs. A set ends
when every expected name is there (`complete`), or when the waiting time has passed since its first file was seen
(`overdue`, with what has come). Its state goes with it; a file that comes later opens the set anew. Time is that of the
batch, not of the files: a file that is older than one already seen would be dropped as late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.streaming.ingest import BatchWriter

_ENDED = "set string, status string, names array<string>, paths array<string>"
_FILES = "path string, modificationTime timestamp, length long, content binary"
_HELD = "names array<string>, paths array<string>, due long"


def arriving_names(spark: SparkSession, folder: str, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of (set, name, path) of the files below a folder; contents are not read.

    `pattern` has two groups, the set and the name within it, found in the path. Files that it does not match are left out.
    """
    reader = spark.readStream.schema(_FILES).format("binaryFile").option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = [F.regexp_extract("path", pattern, i) for i in (1, 2)]
    files = reader.load(folder).select(found[0].alias("set"), found[1].alias("name"), "path")
    return files.where("set <> ''")


def ended_sets(files: DataFrame, expected: Sequence[str], wait: timedelta) -> DataFrame:
    """(set, status, names, paths) of the sets that are complete or overdue; names and paths are sorted.

    `files`: a stream of (set, name, path). A name may come more than once, and all its paths are given; names that are
    not expected are given as well and complete nothing. A null set takes no part. Overdue sets are told by the first
    batch with any new file after their time. State is as large as the names and paths of the sets that are open.
    """
    wanted, waiting = frozenset(expected), int(wait.total_seconds() * 1000)

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, paths, due = state.get if state.exists else ([], [], None)
        names, paths = set(names), set(paths)
        status = "overdue" if state.hasTimedOut else None
        for rows in batches:
            names.update(rows["name"].dropna())
            paths.update(rows["path"].dropna())
            if due is None:
                due = int(rows["seen"].max().timestamp() * 1000) + waiting
        if wanted <= names:
            status = "complete"
        if status:
            state.remove()
            yield pd.DataFrame({"set": [key[0]], "status": [status], "names": [sorted(names)], "paths": [sorted(paths)]})
        else:
            state.update((sorted(names), sorted(paths), due))
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    named = files.where(F.col("set").isNotNull()).select(
        F.col("set").cast("string").alias("set"), "name", "path", F.current_timestamp().alias("seen")
    )
    return named.withWatermark("seen", "0 seconds").groupBy("set").applyInPandasWithState(
        follow, _ENDED, _HELD, "append", GroupStateTimeout.EventTimeTimeout
    )


def load_sets(read: Callable[[SparkSession, list[str]], DataFrame], data: str, overdue: str) -> BatchWriter:
    """Read the files of complete sets at once and write them to `data`, one folder a set; report the others in `overdue`.

    `read` gives the rows of some paths with their column `set`. A repeated batch replaces its own folders. The driver
    sees the paths of one batch of sets.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ended = batch.select("set", "status", "names", "paths").collect()
        paths = [p for row in ended if row["status"] == "complete" for p in row["paths"]]
        if paths:
            rows = read(spark, paths)
            writer = rows.hint("rebalance", F.col("set")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("set").parquet(data)
        left = [(row["set"], row["names"]) for row in ended if row["status"] == "overdue"]
        if left:
            report = spark.createDataFrame(left, "set string, names array<string>").withColumn("batch_id", F.lit(batch_id))
            writer = report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id").parquet(overdue)

    return write
