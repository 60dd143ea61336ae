"""Document ingest: which documents are missing, and what is stored of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import elements, path
from millrace.functions.text import ruby_hash_to_json
from millrace.operators.crypto import ENVELOPE, envelope_error, open_envelope
from millrace.operators.incremental import not_in, not_yet_loaded
from millrace.operators.joins import join_unique

# Document and report kinds that are ingested.
BANK_DOCUMENT = "flinks_raw_response"
BUSINESS_REPORTS = ("equifax_business_default", "equifax_personal_default")


def owned_documents(documents: DataFrame, owners: DataFrame, kind: str) -> DataFrame:
    """(owner guid, file path) of landed document rows of one kind.

    `owners` is unique by id; an owner with very many documents is split by the
    adaptive join.
    """
    files = documents.where(path("fields", "doc_type") == kind).select(
        path("fields", "document_owner_id", "long").alias("owner_id"),
        path("fields", "cloud_file_path").alias("file_path"),
    )
    people = owners.select(
        path("fields", "id", "long").alias("owner_id"), path("fields", "guid").alias("merchant_guid")
    )
    return files.join(people, "owner_id").select("merchant_guid", "file_path")


def pending_documents(documents: DataFrame, owners: DataFrame, stored: DataFrame, kind: str) -> DataFrame:
    """Owned documents whose (guid, path) is not stored yet."""
    return not_yet_loaded(owned_documents(documents, owners, kind), stored, ["merchant_guid", "file_path"])


def pending_reports(reports: DataFrame, stored: DataFrame, kinds: Sequence[str] = BUSINESS_REPORTS) -> DataFrame:
    """Report keys of the listed kinds that are not stored yet."""
    wanted = reports.where(path("fields", "report_type").isin(list(kinds))).select(
        path("fields", "lookup_key").alias("lookup_key")
    )
    return not_in(wanted, stored, "lookup_key")


def open_documents(fetched: DataFrame, keys: DataFrame) -> DataFrame:
    """Add `text`, the plain text of each fetched envelope (URL-safe base64 inside), and `open_error`.

    A document that was not fetched keeps a null text and its fetch error; one
    that cannot be opened has a null text and the reason in `open_error`.
    """
    envelope = F.from_json(F.col("body").cast("string"), ENVELOPE)
    key_of = keys.select(F.col("wrapped_key").alias("_wrapped"), F.col("data_key").alias("_data_key"))
    # Documents without a key do not meet in one task.
    no_key = F.concat(F.lit("none:"), F.xxhash64(*fetched.drop("body").columns).cast("string"))
    error = envelope_error(F.col("_envelope"), F.col("_data_key"), F.col("text"))
    return (
        join_unique(
            fetched.withColumn("_envelope", envelope).withColumn(
                "_wrapped", F.coalesce(F.translate("_envelope.key", "-_", "+/"), no_key)
            ),
            key_of,
            ["_wrapped"],
            "left",
        )
        .withColumn("text", open_envelope(F.col("_envelope"), F.col("_data_key"), url_safe=True))
        .withColumn("open_error", F.when(F.col("body").isNotNull(), error))
        .drop("_envelope", "_wrapped", "_data_key", "body")
    )


def rejected_documents(opened: DataFrame) -> DataFrame:
    """The documents that were fetched but could not be opened, and why; the next run tries them again."""
    return opened.where(F.col("open_error").isNotNull()).drop("text")


def stored_bank_documents(opened: DataFrame, safe: bool = False) -> DataFrame:
    """One VARIANT row per account of each document; a lone object is one account.

    A document that was not fetched or cannot be read gives no row, so the next
    run finds it missing and tries again.
    """
    return opened.select(
        "merchant_guid",
        F.col("last_modified_at").alias("batch_timestamp"),
        "file_path",
        F.explode(elements(ruby_hash_to_json(F.col("text"), safe))).alias("raw_response"),
    )


def stored_reports(opened: DataFrame, batch_ts: Column) -> DataFrame:
    """Response rows of the reports that were opened; the others are tried again next run."""
    return opened.where(F.col("text").isNotNull()).select(
        "lookup_key",
        F.col("text").alias("raw_response"),
        "last_modified_at",
        batch_ts.alias("batch_import_timestamp"),
    )
