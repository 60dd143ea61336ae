"""Call ingest: entries of day reports that are not stored yet, with their recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import path
from millrace.operators.incremental import not_yet_loaded

CALL_TABLE = "call variant, recordings variant"


def entries_of(reports: DataFrame, body: str = "body") -> DataFrame:
    """Calls of landed day reports (JSON text) as VARIANT, one row per entry, with their id."""
    entries = F.try_variant_get(F.try_parse_json(body), "$.entries", "array<variant>")
    calls = reports.select(F.explode(entries).alias("call"))
    return calls.select(path("call", "call_id").alias("call_id"), "call")


def new_calls(entries: DataFrame, stored: DataFrame, recordings: DataFrame) -> DataFrame:
    """Rows to append to a call table: unknown entries and the recordings document of each.

    `stored` is the call table and `recordings` has `call_id` and the landed JSON
    text in `body`, once per call. A call without a document keeps a null.
    """
    known = stored.select(path("call", "call_id").alias("call_id"))
    fresh = not_yet_loaded(entries, known, ["call_id"])
    found = recordings.select("call_id", F.try_parse_json("body").alias("recordings"))
    return fresh.join(found, "call_id", "left").select("call", "recordings")
