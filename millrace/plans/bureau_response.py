"""Bureau responses: fixed-width consumer file and commercial CSV files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import INPUT_ERRORS, failure
from millrace.functions.dates import load_time, month_before, pivot_date
from millrace.operators.typed import TypedColumn, typed_select
from millrace.sinks.tables import append_table, replace_table_as, with_leading, write_dated_copy
from millrace.sources.files import audited, read_csv_by_name
from millrace.sources.fixedwidth import drop_markers, parse, read_lines
from millrace.sources.layout import PERSONAL_END_OFFSETS, Layout


def raw_response(
    lines: DataFrame, layout: Layout, columns: Sequence[str] | None = None, in_batches: bool = False
) -> DataFrame:
    """Sliced response rows, personal fields emptied before anything is stored."""
    return parse(drop_markers(lines), layout, layout.ending_at(PERSONAL_END_OFFSETS), columns, in_batches=in_batches)


def staged_response(raw: DataFrame, date_columns: Sequence[str], as_of: dt.date) -> DataFrame:
    """Response rows with the `MMddyy` columns as dates."""
    present = [c for c in raw.columns if c in date_columns]
    return raw.withColumns({c: pivot_date(F.col(c), as_of) for c in present})


def public_response(staged: DataFrame, import_month: str, import_ts: Column | str) -> DataFrame:
    empty = F.lit(None).cast("string")
    return with_leading(
        staged,
        {
            "import_month": F.lit(import_month),
            "accountid": empty,
            "contractid": empty,
            "business_name": empty,
            "import_ts": F.lit(import_ts) if isinstance(import_ts, str) else import_ts,
        },
    )


@dataclass(frozen=True)
class ResponseTargets:
    raw: str
    raw_history: str
    staged: str
    staged_history: str
    public: str


def load_consumer_response(
    spark: SparkSession,
    path: str,
    layout: Layout,
    date_columns: Sequence[str],
    run_date: dt.date,
    targets: ResponseTargets,
    import_ts: str | None = None,
    in_batches: bool = False,
) -> None:
    """Landed file to raw, staged and public tables with a dated copy of the first two.

    Ask for `in_batches` with a layout of many hundred fields. Each step reads the table the step before wrote, so the text is sliced once.
    """
    month = month_before(run_date)
    replace_table_as(raw_response(read_lines(spark, path), layout, in_batches=in_batches), targets.raw, layout.ddl())
    raw = spark.table(targets.raw)
    write_dated_copy(raw, targets.raw_history, month)
    replace_table_as(staged_response(raw, date_columns, run_date), targets.staged, layout.ddl(date_columns))
    staged = spark.table(targets.staged)
    write_dated_copy(staged, targets.staged_history, month)
    append_table(public_response(staged, month, load_time(import_ts)), targets.public)


def load_commercial_responses(
    spark: SparkSession,
    files: Mapping[str, tuple[str, list[TypedColumn], str]],
    run_date: dt.date,
    import_ts: str | None = None,
    newlines_in_values: bool = False,
) -> dict[str, str]:
    """Load each `{file name: (path, spec, table)}`; tells what happened per file.

    Columns are found by the names in a file's header, in any order. A file that
    cannot be read or cast, lacks a column, or has a line with more or fewer
    cells than its header fails alone; nothing is loaded for it. Ask for
    `newlines_in_values` if cells hold line breaks.
    """
    month = month_before(run_date)
    outcome = {}
    for name, (path, spec, table) in files.items():
        try:
            rows = read_csv_by_name(spark, path, _source_columns(spec), newlines_in_values)
            if rows.isEmpty():
                outcome[name] = "empty"
                continue
            stamped = audited(
                rows,
                imported_file_name=name,
                import_month=month,
                import_ts=load_time(import_ts),
            )
            append_table(typed_select(stamped, spec, strict=True), table)
            outcome[name] = "loaded"
        except INPUT_ERRORS as error:
            outcome[name] = failure(error)
    return outcome


_AUDIT = ("imported_file_name", "import_month", "import_ts")


def _source_columns(spec: list[TypedColumn]) -> list[str]:
    return list(dict.fromkeys(c.source for c in spec if c.source and c.source not in _AUDIT))
