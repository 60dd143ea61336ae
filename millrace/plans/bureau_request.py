"""Bureau request datasets: who is asked about, and the request lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.address import ADDRESS_FIELDS, address_lines, clean_address, phone_text
from millrace.functions.dates import birth_date_tag, days_since
from millrace.functions.text import clean_name, to_string, zero_fill
from millrace.operators.quality import is_valid, validate_lines
from millrace.operators.ranges import with_row_id
from millrace.sinks.requests import frame_lines, write_lines
from millrace.sources.fixedwidth import read_lines, render
from millrace.sources.layout import REQUEST_LAYOUT

# The loan rule and the relationship kinds.
EXCLUDED_FACILITY = "O"
REPAID_WITHIN_DAYS = 365
APPLICANT_PARTY, APPLICANT_ADDRESS = "Individuals::Applicant", "physical_address"
MERCHANT_PARTY, MERCHANT_ADDRESS = "Entities::Merchant", "legal_business_address"
MERCHANT_PHONE = "business_phone_number"
APPLICANT_ATTRIBUTES = ("suffix", "sin", "file_number")


def eligible_loans(loans: DataFrame, as_of: dt.date) -> DataFrame:
    """Open balance, or closed and repaid within a year; a null facility is out."""
    repaid = days_since(F.try_to_date("fully_repaid_at"), as_of)
    recent = (repaid <= REPAID_WITHIN_DAYS) & (F.col("state") == "closed")
    return loans.where(
        (F.col("facility_code") != EXCLUDED_FACILITY) & (recent | (F.col("outstanding_balance") != 0.0))
    )


def active_links(links: DataFrame, party_type: str, category: str) -> DataFrame:
    return links.where(
        (F.col("party_type") == party_type) & (F.col("active") == "t") & (F.col("category") == category)
    )


def attribute(attributes: DataFrame, owner: str, key: str, name: str) -> DataFrame:
    """One key of a key/value table as a lookup; exact copies count once."""
    return (
        attributes.where(F.col("key") == key)
        .select(owner, F.col("encrypted_value").alias(name))
        .distinct()
    )


def linked(links: DataFrame, targets: DataFrame, link_key: str, fields: Sequence[str]) -> DataFrame:
    """`party_id` and the target's fields, once per distinct combination."""
    pairs = links.select(F.col("party_id").cast("long"), F.col(link_key).cast("long")).distinct()
    wanted = targets.select(F.col(link_key).cast("long"), *fields)
    return pairs.join(wanted, link_key, "left").select("party_id", *fields)


def _numbered(rows: DataFrame, guid: str) -> DataFrame:
    """Distinct rows numbered by guid; the other columns break ties."""
    rows = rows.distinct()
    return with_row_id(rows, [guid, *[c for c in rows.columns if c != guid]])


def consumer_request(
    applicants: DataFrame,
    attributes: DataFrame,
    links: DataFrame,
    addresses: DataFrame,
    loans: DataFrame,
    merchants: DataFrame,
    as_of: dt.date,
    manual_guids: Sequence[str] = (),
    excluded_guids: Sequence[str] = (),
) -> DataFrame:
    """Primary applicants of merchants with an eligible loan, plus a manual list.

    Only applicant columns come from the eligibility joins, so they are
    semi-joins on keys cut to distinct values first. The lookups are left joins
    on the applicant id; an applicant with several addresses keeps several rows.
    """
    borrowers = eligible_loans(loans, as_of).select("merchant_guid").distinct()
    wanted = (
        merchants.withColumnRenamed("guid", "merchant_guid")
        .join(borrowers, "merchant_guid", "left_semi")
        .select(F.col("primary_applicant_guid").alias("applicant_guid"))
    )
    if manual_guids:
        listed = applicants.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(g) for g in manual_guids])).alias("applicant_guid")
        )
        wanted = wanted.union(listed)
    rows = applicants.where(~F.col("applicant_guid").isin(list(excluded_guids))).join(
        wanted.distinct(), "applicant_guid", "left_semi"
    )
    for key in APPLICANT_ATTRIBUTES:
        lookup = attribute(attributes, "applicant_id", key, f"encrypted_{key}")
        rows = rows.join(lookup, "applicant_id", "left")
    homes = linked(
        active_links(links, APPLICANT_PARTY, APPLICANT_ADDRESS), addresses, "address_id", ADDRESS_FIELDS
    ).withColumnRenamed("party_id", "applicant_id")
    rows = rows.join(homes, "applicant_id", "left").drop("applicant_id")
    return _numbered(rows, "applicant_guid")


def commercial_request(
    merchants: DataFrame,
    attributes: DataFrame,
    address_links: DataFrame,
    addresses: DataFrame,
    phone_links: DataFrame,
    phones: DataFrame,
    loans: DataFrame,
    as_of: dt.date,
    excluded_guids: Sequence[str] = (),
) -> DataFrame:
    """Merchants with an eligible loan, their address, phone and file number.

    Party ids arrive as text on one side and numbers on the other; both are
    compared as long.
    """
    borrowers = eligible_loans(loans, as_of).select("merchant_guid").distinct()
    rows = (
        merchants.where(~F.col("merchant_guid").isin(list(excluded_guids)))
        .join(borrowers, "merchant_guid", "left_semi")
        .withColumn("party_id", F.col("merchant_id").try_cast("long"))
    )
    offices = linked(
        active_links(address_links, MERCHANT_PARTY, MERCHANT_ADDRESS), addresses, "address_id", ADDRESS_FIELDS
    )
    lines = linked(
        active_links(phone_links, MERCHANT_PARTY, MERCHANT_PHONE),
        phones,
        "phone_number_id",
        ("area_code", "country_code", "phone_number"),
    )
    file_numbers = attribute(attributes, "business_id", "file_number", "encrypted_file_number")
    rows = (
        rows.join(offices, "party_id", "left")
        .join(lines, "party_id", "left")
        .join(file_numbers, "business_id", "left")
        .drop("party_id", "merchant_id", "business_id")
    )
    return _numbered(rows, "merchant_guid")


def request_counts(rows: DataFrame, guid: str) -> DataFrame:
    """Lines and distinct entities of a request, for the run log."""
    return rows.agg(F.count(F.lit(1)).alias("lines"), F.count_distinct(guid).alias("entities"))


def consumer_fields() -> dict[str, Column]:
    """Request fields of decrypted applicant columns with cleaned address fields."""
    sin = to_string(F.col("sin"))
    return {
        "reference_number": zero_fill(F.col("id"), 12),
        "last_name": clean_name(F.col("last_name")),
        "first_name": clean_name(F.col("first_name")),
        "middle_name": clean_name(F.col("middle_name")),
        "suffix": clean_name(F.col("suffix")),
        "sin": F.when(sin == "", "0" * 9).otherwise(sin),
        "date_of_birth": birth_date_tag(to_string(F.col("date_of_birth"))),
        "civic_line": address_lines(),
        "city": F.col("city"),
        "province_code": F.col("state_province"),
        "postal_code": F.col("postal_code"),
        "file_number": to_string(F.col("file_number")),
        "applicant_guid": F.col("applicant_guid"),
    }


def consumer_lines(rows: DataFrame) -> DataFrame:
    """(id, line): one fixed-width line per decrypted request row."""
    return clean_address(rows).select("id", render(REQUEST_LAYOUT, consumer_fields()).alias("line"))


def publish_request(rows: DataFrame, stamp: dt.datetime, draft: str, validated: str) -> DataFrame:
    """Write the request file, check it as written, and hand it on when it has no fault.

    Gives the faults; `validated` is only written when there are none.
    """
    spark = rows.sparkSession
    write_lines(frame_lines(consumer_lines(rows), stamp), draft)
    lines = read_lines(spark, draft, "windows-1252")
    errors = validate_lines(lines)
    if is_valid(errors):
        write_lines(lines.select(F.col("pos").alias("id"), F.col("value").alias("line")), validated)
    return errors


def commercial_rows(rows: DataFrame) -> DataFrame:
    """The eight CSV columns of a commercial request; the fax is always empty."""
    return clean_address(rows).select(
        F.col("merchant_guid").alias("reference_number"),
        F.coalesce("name", F.lit("")).alias("business_name"),
        address_lines().alias("address"),
        F.col("city"),
        F.col("state_province").alias("province"),
        F.col("postal_code"),
        phone_text(F.col("area_code"), F.col("phone_number")).alias("phone"),
        F.lit("").alias("fax"),
    )
