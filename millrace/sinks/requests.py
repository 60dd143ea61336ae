"""Request files: framed fixed-width lines and CSV rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import encode_bytes, zero_fill
from millrace.sources.layout import HEADER_PREFIX, MARKER_SUFFIX, TRAILER_PREFIX


def frame_lines(body: DataFrame, stamp: datetime) -> DataFrame:
    """Put header and trailer around (id, line) rows whose ids count from 1.

    The header gets id 0 and the trailer the last id plus one, so sorting by id
    gives the file.
    """
    tag = stamp.strftime("%Y%m%d%H%M%S")
    edges = body.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    trailer = F.concat(F.lit(f"{TRAILER_PREFIX}{tag}{MARKER_SUFFIX}"), zero_fill(F.col("n"), 8))
    marks = edges.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit(0).cast("long").alias("id"),
                    F.lit(f"{HEADER_PREFIX}{tag}{MARKER_SUFFIX}").alias("line"),
                ),
                F.struct((F.col("last") + 1).cast("long").alias("id"), trailer.alias("line")),
            )
        ).alias("m")
    ).select("m.*")
    return body.select(F.col("id").cast("long").alias("id"), "line").unionByName(marks)


def write_lines(lines: DataFrame, path: str, charset: str = "windows-1252", files: int | None = None) -> None:
    """Write (id, line) rows in id order.

    The lines are range partitioned and every task writes its own range; the
    part files in name order are the file. Nothing passes through one task, and
    a transport that needs a single object concatenates the parts. Text parts
    end with a newline, so the trailer has one too.
    """
    ranges = files or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(ranges, "id")
        .sortWithinPartitions("id")
        .select(encode_bytes(F.col("line"), charset).alias("value"))
        .write.text(path)
    )
