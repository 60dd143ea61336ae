"""Report load: landed pages to an upserted table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.upsert import delete_insert, swap_table
from millrace.sinks.filetable import merge_files
from millrace.sinks.tables import replace_table, restore_table
from millrace.sources.reports import Report, flatten_report


def load_report(pages: DataFrame, report: Report, table: str, run_date: str, import_ts: str) -> None:
    """Flatten the pages of one run and upsert them by the report's keys.

    The first run creates the table. Records of the run replace stored ones with
    equal keys; copies within the run all stay.
    """
    spark = pages.sparkSession
    stage = flatten_report(pages, report.columns, run_date, import_ts)
    if restore_table(spark, table):
        swap_table(delete_insert(spark.table(table), stage, report.keys), table)
    else:
        replace_table(stage, table)


def load_report_files(pages: DataFrame, report: Report, path: str, run_date: str, import_ts: str) -> list[str]:
    """Like `load_report`, into a table of files at `path`: only files that hold a key of the run are written again.

    Returns the names of the files that the run replaced.
    """
    return merge_files(flatten_report(pages, report.columns, run_date, import_ts), path, report.keys)
