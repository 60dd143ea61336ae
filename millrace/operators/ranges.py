"""Ordered computations over groups of any size.

A window over one key needs the whole key in one task. Here the rows are range
partitioned on (keys, order), so a hot key spans many tasks. Each row keeps the
number of its range (`chunk`) and its position there (`pos`); what crosses a
range border is computed on one row per key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


_FIRST, _LAST = -1, 1 << 62  # positions of the extra rows


def _range_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Range partition and sort on (keys, order) and write the result down.

    `keys + order` must be unique, else one tuple could not be split. Written
    to the shared folder because `chunk` must not change if a task is rerun.
    """
    columns = [*keys, *order]
    row = F.monotonically_increasing_id()
    ordered = (
        df.repartitionByRange(ranges or _range_count(df), *columns)
        .sortWithinPartitions(*columns)
        .withColumn("_row", row)
        .withColumn("chunk", F.shiftright("_row", _POSITION_BITS).cast("int"))
        .withColumn("pos", F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_row")
    )
    return materialize(ordered, "ordered")


def running_total_before(
    ordered: DataFrame, keys: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Sum of `value` over the earlier rows of the key; the first row has zero.

    What earlier ranges add up to enters each range as one extra first row, so
    the totals need no join back to the rows.
    """
    before = W.unboundedPreceding, -1
    totals = ordered.groupBy(*keys, "chunk").agg(F.sum(value).alias("_total"))
    carried = F.sum("_total").over(W.partitionBy(*keys).orderBy("chunk").rowsBetween(*before))
    carry = totals.select(*keys, "chunk", F.lit(_FIRST).cast("long").alias("pos"), carried.alias("_value"))
    rows = ordered.withColumn("_value", value).unionByName(carry, allowMissingColumns=True)
    total = F.sum("_value").over(_inside(keys).rowsBetween(*before))
    return _without_borders(rows.withColumn(name, F.coalesce(total, F.lit(0)))).drop("_value")


def next_in_order(ordered: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """`column` of the following row of the key; null on the last row.

    The first value of the next range enters each range as one extra last row.
    """
    firsts = ordered.groupBy(*keys, "chunk").agg(F.min_by(column, "pos").alias("_first"))
    following = F.lead("_first").over(W.partitionBy(*keys).orderBy("chunk"))
    border = firsts.select(*keys, "chunk", F.lit(_LAST).cast("long").alias("pos"), following.alias("_value"))
    rows = ordered.withColumn("_value", F.col(column)).unionByName(border, allowMissingColumns=True)
    return _without_borders(rows.withColumn(name, F.lead("_value").over(_inside(keys)))).drop("_value")


def _inside(keys: Sequence[str]):
    return W.partitionBy(*keys, "chunk").orderBy("pos")


def _without_borders(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("pos").between(_FIRST + 1, _LAST - 1))


def with_row_id(
    df: DataFrame, order: Sequence[str], name: str = "id", ranges: int | None = None
) -> DataFrame:
    """`row_number() over (order by ...)` without a single-task window.

    Rows are numbered inside their range; the offset of a range is the count of
    the ranges before it, one row per range, joined back. `order` must be unique.
    """
    ordered = in_order(df, [], order, ranges)
    # One row per range: the unpartitioned window below sees at most `ranges` rows.
    counts = ordered.groupBy("chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.join(F.broadcast(offsets), "chunk")
        .withColumn(name, F.col("_offset") + F.col("pos") + 1)
        .select(name, *df.columns)
    )
