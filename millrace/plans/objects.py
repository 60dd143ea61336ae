"""Incremental load of objects that are appended by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.operators.incremental import high_watermark, newer_than
from millrace.operators.wide import PARTS, WIDE_THRESHOLD, part_columns
from millrace.session import materialize
from millrace.sinks.tables import append_table
from millrace.sources.extract import extract_rows, usable_fields, watermark_column
from millrace.sources.files import audited


def load_object(
    source: DataFrame,
    name: str,
    schema: str,
    import_ts: str,
    key: str = "Id",
    filters: Sequence[str] = (),
    parts: int = PARTS,
    threshold: int = WIDE_THRESHOLD,
) -> dict[str, str]:
    """Append the rows of an object that are newer than what each part table holds.

    A wide object is split by columns into part tables that share the key and
    the watermark. The choice is made at the first load and kept: a stored
    object that grows past the threshold stays whole, and a split one split.
    Every part keeps its own watermark, so a part that failed in an earlier run
    catches up alone. The source is read once, behind the lowest watermark.
    Tells what happened per table.
    """
    spark = source.sparkSession
    if source.isEmpty():
        return {}
    fields = usable_fields(name, source.dtypes)
    watermark = watermark_column(name, fields)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    tables = [f"{schema}.{name}___PART_{i}" for i in range(parts)]
    stored = [t for t in tables if spark.catalog.tableExists(t)]
    if stored:
        threshold = 0 if len(stored) > 1 else len(fields) + 1
    split = part_columns(fields, [key, watermark], parts, threshold)
    marks = {t: high_watermark(spark.table(t), watermark) for t in stored}
    known = [marks.get(t) for t, _ in zip(tables, split)]
    lowest = None if None in known else min(known)
    increment = materialize(extract_rows(source, fields, watermark, lowest, filters), "increment")
    outcome = {}
    for table, columns in zip(tables, split):
        fresh = newer_than(increment.select(*columns), watermark, marks.get(table))
        if fresh.isEmpty():
            outcome[table] = "nothing new"
            continue
        append_table(audited(fresh, import_ts=import_ts), table)
        outcome[table] = "appended"
    return outcome
