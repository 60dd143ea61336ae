"""Keep-latest, delete-and-insert, table swap, history tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.joins import join_unique
from millrace.operators.ranges import in_order, next_in_order
from millrace.session import materialize
from millrace.sinks.tables import swap_in, write_partitions

BUCKET = "key_bucket"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def union_all(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `latest_by` (give a tiebreak last).

    The filter on the row number lets the planner keep one row per key and task
    before the shuffle, so a hot key sends at most one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in latest_by])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def delete_insert(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys are not staged, then every staged row.

    Keys compare with `=`: a null key matches nothing, and copies inside the
    stage all stay.
    """
    kept = join_unique(target, stage.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(stage)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The Parquet table at `path`, empty before the first write."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def rewrite_partitions(
    spark: SparkSession, path: str, stage: DataFrame, partition: str, merge: Merge
) -> None:
    """Merge `stage` into a partitioned Parquet table, rewriting touched partitions only.

    The staged partition values become literals, so the scan lists only the
    folders that will be replaced, the one of null among them; the driver sees
    one value per folder, as the write does. The stage is evaluated once. A
    repeated run gives the same table.
    """
    stage = materialize(stage, "stage")
    target = _stored(spark, path, stage)
    values = [r[0] for r in stage.select(partition).distinct().collect()]
    replaced = F.col(partition).isin([v for v in values if v is not None])
    target = target.where(replaced | F.col(partition).isNull() if None in values else replaced)
    # A table cannot be read and overwritten at once: write aside first.
    write_partitions(materialize(merge(target, stage), "partitions"), path, partition)


def delete_insert_partitions(
    spark: SparkSession, path: str, stage: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """`delete_insert` on a partitioned table; `partition` must be one of the keys."""
    rewrite_partitions(spark, path, stage, partition, lambda old, new: delete_insert(old, new, keys))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the bucket of the keys, to partition a table that has no natural partition."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_latest_buckets(
    spark: SparkSession,
    path: str,
    fresh: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    buckets: int,
) -> None:
    """Merge rows into a table that keeps the latest row per key.

    The table is partitioned by a hash of the keys, so an increment rewrites the
    buckets of its own keys and leaves the rest of the table alone. Always use
    the same number of buckets for one table.
    """

    def latest(*frames: DataFrame) -> DataFrame:
        return keep_latest(union_all(*frames), keys, latest_by)

    stage = with_bucket(fresh, keys, buckets)
    rewrite_partitions(spark, path, latest(stage), BUCKET, latest)


def swap_table(df: DataFrame, table: str) -> None:
    """Replace `table` by `df`, which may read it: write aside, then exchange the names."""
    swap_in(df.sparkSession, table, df.write.mode("overwrite").saveAsTable)


def replicate_tables(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> list[str]:
    """Copy each source table over its target by swap; the list is configuration."""
    done = []
    for source, target in pairs:
        swap_table(spark.table(source), target)
        done.append(target)
    return done


def snapshot(history: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Type-2 history merge by a change time.

    `history` has the columns of `current` plus `valid_from` and `valid_to`;
    an open row has a null `valid_to`. `current` has one row per key, and so do
    the open rows: one join, one to one, gives the ended and the added rows.
    Closed rows are passed through.
    """
    columns = current.columns
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(
        F.col(key).alias("_key"), F.struct(*columns, "valid_from").alias("old")
    )
    new = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    seen = F.col(f"new.{updated_at}")
    changed = seen > F.col("old.valid_from")
    never = F.lit(None).cast(current.schema[updated_at].dataType)

    def row(side: str, valid_from: Column, valid_to: Column) -> Column:
        kept = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*kept, valid_from.alias("valid_from"), valid_to.alias("valid_to"))

    kept_or_ended = row("old", F.col("old.valid_from"), F.when(changed, seen))
    added = row("new", seen, never)
    rows = F.array(
        F.when(F.col("old").isNotNull(), kept_or_ended),
        F.when(F.col("new").isNotNull() & (F.col("old").isNull() | changed), added),
    )
    merged = old.join(new, "_key", "full").select(F.explode(F.array_compact(rows)).alias("r"))
    return history.where(~is_open).unionByName(merged.select("r.*"))


def history_from_versions(
    versions: DataFrame, keys: Sequence[str], changed_at: Sequence[str]
) -> DataFrame:
    """`valid_from` and `valid_to` for a table that holds every version.

    `keys + changed_at` must be unique. A key may have any number of versions:
    they are ordered by range partitions, not gathered in one window.
    """
    ordered = in_order(versions, keys, changed_at)
    return (
        next_in_order(ordered, keys, changed_at[0], "valid_to")
        .withColumn("valid_from", F.col(changed_at[0]))
        .drop("chunk", "pos")
    )
