"""Incremental extracts of objects: columns, watermark, query text, read ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# From how many rows an extract is read in ranges, and rows per range.
RANGE_READ_THRESHOLD = 2_000_000
ROWS_PER_RANGE = 250_000

# Child objects are ranged by the key of their parent. The ending
# of the child's name and what replaces it.
CHILD_ENDINGS = (
    ("__History", "__c"),
    ("__Share", "__c"),
    ("FieldHistory", ""),
    ("History", ""),
    ("Share", ""),
)

# Column names and objects that cannot be extracted.
DENIED_TYPES = ("address",)
DENIED_COLUMNS = ("Language", "IndividualId", "IsVerified", "OutOfOfficeMessage")
OBJECTS_WITH_DENIED_COLUMNS = ("Case", "Contact", "FeedComment", "Lead", "User")


def usable_fields(name: str, fields: Sequence[tuple[str, str]]) -> list[str]:
    """Extractable fields of an object, from (field, type) pairs."""
    denied = DENIED_COLUMNS if name in OBJECTS_WITH_DENIED_COLUMNS else ()
    return [f for f, kind in fields if kind not in DENIED_TYPES and f not in denied]


def watermark_column(name: str, fields: Sequence[str]) -> str:
    """The column that tells which rows of an object are new."""
    if "SystemModstamp" not in fields:
        return "LastModifiedDate" if "LastModifiedDate" in fields else "CreatedDate"
    if name.endswith("History"):
        return "CreatedDate"
    return "LastModifiedDate" if name.endswith("Share") else "SystemModstamp"


def parent_object(name: str) -> str | None:
    for ending, replacement in CHILD_ENDINGS:
        if name.endswith(ending):
            return name.removesuffix(ending) + replacement
    return None


def extract_rows(
    source: DataFrame,
    fields: Sequence[str],
    watermark: str,
    newer_than: datetime | None = None,
    filters: Sequence[str] = (),
) -> DataFrame:
    """The wanted fields of the rows behind the watermark; Spark pushes the predicates into the scan."""
    for condition in filters:
        source = source.where(condition)
    if newer_than is not None:
        source = source.where(F.col(watermark) > F.lit(newer_than))
    return source.select(*fields)


def range_count(rows: int, threshold: int = RANGE_READ_THRESHOLD, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """In how many key ranges a database table with so many rows to load is read."""
    return -(-rows // rows_per_range) if rows > threshold else 1


def read_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    ranges: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a database table in parallel ranges of its numeric key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=max(1, ranges),
        properties=dict(properties or {}),
    )
