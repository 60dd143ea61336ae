"""Vertical split of wide tables and the join that puts them together again."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# From how many fields a table is split, and into how many parts.
WIDE_THRESHOLD = 200
PARTS = 16


def part_columns(
    fields: Sequence[str],
    always: Sequence[str],
    parts: int = PARTS,
    threshold: int = WIDE_THRESHOLD,
) -> list[list[str]]:
    """Columns of each part; every part starts with `always`.

    The part of a column is a checksum of its name, the same in every run.
    """
    if len(fields) < threshold:
        return [list(fields)]
    out = [list(always) for _ in range(parts)]
    for name in fields:
        if name not in always:
            out[zlib.crc32(name.encode()) % parts].append(name)
    return out


def write_parts(
    df: DataFrame, table: str, always: Sequence[str], columns: list[list[str]], buckets: int
) -> list[str]:
    """Write each part as a table bucketed and sorted by the `always` columns.

    Equal bucketing makes the later rejoin free of shuffles. The input is spread
    by those columns once, so every task writes its own buckets only.
    """
    spread = df.repartition(buckets, *always)
    names = []
    for i, part in enumerate(columns):
        name = f"{table}___part_{i}"
        (
            spread.select(*part)
            .write.mode("overwrite")
            .bucketBy(buckets, *always)
            .sortBy(*always)
            .saveAsTable(name)
        )
        names.append(name)
    return names


def rejoin_parts(spark: SparkSession, tables: Sequence[str], always: Sequence[str]) -> DataFrame:
    """All parts side by side, joined on the `always` columns, which must be unique."""
    out = spark.table(tables[0])
    for name in tables[1:]:
        out = out.join(spark.table(name), list(always))
    return out
