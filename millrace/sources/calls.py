"""Call reports landed per day: day slices, new entries, nested recordings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDINGS_SCHEMA = """
struct<_embedded: struct<recordings: array<struct<
  id: string, _links: struct<media: struct<href: string>>>>>>
"""


def day_slices(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per whole day of [start, end): `from_ts`, `to_ts`."""
    last = max(start, end - dt.timedelta(days=1))
    days = F.sequence(F.lit(start), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1 if start < end else 0).select(F.explode(days).alias("d")).select(
        F.col("d").cast("timestamp").alias("from_ts"),
        F.date_add("d", 1).cast("timestamp").alias("to_ts"),
    )


def report_entries(reports: DataFrame) -> DataFrame:
    """Calls of landed day reports, one row per entry."""
    return reports.select(F.explode("entries").alias("call"))


def explode_recordings(calls: DataFrame) -> DataFrame:
    """`call_id`, `recording_id`, `media_link`; a call without recordings keeps one row."""
    recordings = F.col("recordings._embedded.recordings")
    rows = calls.select(F.col("call.call_id").alias("call_id"), F.explode_outer(recordings).alias("r"))
    return rows.select(
        "call_id",
        F.col("r.id").alias("recording_id"),
        F.col("r._links.media.href").alias("media_link"),
    )
