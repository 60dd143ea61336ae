"""Parquet tables whose merges rewrite only the files that hold a merged key.

Layout below the path of a table: `data/commit=<id>/` has the files of each commit, `log/version=<n>` one row per commit
with its id and the names of the files it replaces. A file is part of the table if its commit is in the log and no
later commit replaces it, so a writer that dies leaves nothing behind that readers see. A table has one writer at a time:
a version that is in the log cannot be written again, and one that two writers made in the same moment is an error for
every reader. Rows lie in key ranges, so the footers say which row groups can hold a key; Parquet Bloom filters on the keys
serve lookups. Replaced files stay until they are removed by name (`replaced_files`).

The driver sees the log: file names of replaced files, and of those a merge touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import join_unique
from millrace.session import materialize

_LOG = "commit string, replaced array<string>, version int"
_FILE = "_file"


def _log(spark: SparkSession, path: str) -> list:
    try:
        rows = spark.read.schema(_LOG).parquet(f"{path}/log").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if len({row["version"] for row in rows}) < len(rows):
        raise ValueError(f"two writers made one version of {path}")
    return sorted(rows, key=lambda r: r["version"])


def replaced_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that are no longer part of the table."""
    return sorted(name for row in _log(spark, path) for name in row["replaced"])


def _live(spark: SparkSession, path: str, log: list) -> DataFrame:
    """The rows of the table and the name of their file, as `_file`. Both conditions are met by listing files, not by reading them."""
    # Every commit has the columns of the first: no footer but one is read for the schema.
    rows = spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/commit={row['commit']}" for row in log])
    gone = [name for row in log for name in row["replaced"]]
    if gone:
        rows = rows.where(~F.col("_metadata.file_name").isin(gone))
    return rows.select(*[c for c in rows.columns if c != "commit"], F.col("_metadata.file_path").alias(_FILE))


def read_files_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version."""
    log = _log(spark, path)
    if not log:
        raise ValueError(f"no table at {path}")
    return _live(spark, path, log).drop(_FILE)


def _commit(rows: DataFrame, path: str, keys: Sequence[str], version: int, replaced: list[str], files: int | None) -> None:
    spark = rows.sparkSession
    name = uuid.uuid4().hex
    cut = [files] if files else []
    # The rows of a hot key differ in other columns, so its range is cut by their hash.
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    writer = rows.repartitionByRange(*cut, *keys, F.xxhash64(*plain)).sortWithinPartitions(*keys).write
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(f"{path}/data/commit={name}")
    entry = spark.createDataFrame([(name, replaced)], "commit string, replaced array<string>").coalesce(1)
    entry.write.mode("error").parquet(f"{path}/log/version={version}")


def merge_files(stage: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> list[str]:
    """Delete and insert by keys: stored rows with a staged key go, all staged rows come. Returns the replaced files.

    The first merge makes the table; later ones must bring its columns. Only files that hold a staged key are read
    whole and written again; of the others the key columns are read at most, and only row groups whose key range meets
    that of the stage. Keys compare with `=`: a null key matches nothing. Copies inside the stage all stay. An empty
    stage changes nothing, but makes an empty table. `files`: into how many key ranges a commit is cut; the session's
    shuffle partitions if not given, fewer where they are small.
    """
    spark = stage.sparkSession
    stage = materialize(stage, "stage")
    log = _log(spark, path)
    if not log:
        _commit(stage, path, keys, 0, [], files)
        return []
    live = _live(spark, path, log)
    if sorted(stage.columns) != sorted(c for c in live.columns if c != _FILE):
        raise ValueError(f"columns of the stage are {stage.columns}, of the table {live.columns[:-1]}")
    bounds = stage.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}_{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]).first()
    if not bounds["n"]:
        return []
    near = live.select(*keys, _FILE)
    for i, key in enumerate(keys):
        near = near.where(F.col(key).between(F.lit(bounds[f"min_{i}"]), F.lit(bounds[f"max_{i}"])))
    staged = stage.select(*keys).distinct()
    touched = [r[0] for r in join_unique(near, staged, keys, "left_semi").select(_FILE).distinct().collect()]
    rows = stage.select(*[c for c in live.columns if c != _FILE])
    if touched:
        old = spark.read.schema(rows.schema).parquet(*touched)
        rows = join_unique(old, staged, keys, "left_anti").select(*rows.columns).unionByName(rows)
    replaced = sorted(file.rsplit("/", 1)[1] for file in touched)
    _commit(rows, path, keys, log[-1]["version"] + 1, replaced, files)
    return replaced
