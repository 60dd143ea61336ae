"""Which rows are new: key sets, change hashes, high-water marks, day slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import join_unique


def not_yet_loaded(df: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key tuple is absent from `loaded`. A null key is never loaded.

    `loaded` is cut to its distinct keys before the shuffle, so copies there
    cost nothing.
    """
    return join_unique(df, loaded.select(*keys).distinct(), keys, "left_anti")


def not_in(df: DataFrame, known: DataFrame, key: str, null_rejects_all: bool = False) -> DataFrame:
    """`key NOT IN (known)`: a null key is dropped.

    A null in `known` is ignored, or rejects every row as SQL does when
    `null_rejects_all`.
    """
    values = known.select(key).distinct()
    out = join_unique(df.where(F.col(key).isNotNull()), values, [key], "left_anti")
    if null_rejects_all and not known.where(F.col(key).isNull()).isEmpty():
        return df.limit(0)
    return out


def already_stored(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is already in `stored`."""
    return join_unique(df, stored.select(key).distinct(), [key], "left_semi")


def high_watermark(target: DataFrame, column: str) -> Any | None:
    """The greatest stored value, or None when there is none.

    One value on the driver, so the filter built from it is a literal that the
    source scan can push down.
    """
    return target.agg(F.max(column).alias("mark")).first()["mark"]


def newer_than(df: DataFrame, column: str, mark: Any | None, overlap: bool = False) -> DataFrame:
    """Rows past the mark. `overlap` also rereads rows that tie with it; load
    those with `delete_insert` so that late ties are not lost."""
    if mark is None:
        return df
    bound = F.lit(mark).cast(df.schema[column].dataType)
    return df.where(F.col(column) >= bound if overlap else F.col(column) > bound)


def count_newer(df: DataFrame, column: str, mark: Any | None) -> int:
    return newer_than(df, column, mark).count()


def on_day(column: Column, day: dt.date) -> Column:
    """`date(column) = day` as a range, which Parquet and JDBC scans can push down."""
    return (column >= F.lit(day).cast("timestamp_ntz")) & (
        column < F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    )


def in_interval(column: Column, start: dt.date, end: dt.date) -> Column:
    """Rows of the days in [start, end): a catch-up over past intervals."""
    return (column >= F.lit(start).cast("timestamp_ntz")) & (column < F.lit(end).cast("timestamp_ntz"))
