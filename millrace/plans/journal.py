"""Journal entries from ledger transactions grouped by correlation id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import local_to_utc
from millrace.operators.joins import join_unique

ACCEPTED, REJECTED = "accepted", "rejected"

# Reject reason and memo texts.
MIXED_SUBSIDIARY = "Different subsidiary"
LINE_MEMO = "Transaction ID: "
ENTRY_MEMO = "Platform Transaction - "


def journal_entries(transactions: DataFrame, created_at: str, zone: str = "America/Toronto") -> DataFrame:
    """One row per correlation id: entry header, status and reject reason.

    A group needs exactly one subsidiary; nulls do not count. The smallest and
    the greatest value tell, which combines before the shuffle where a distinct
    count would not. Transactions without a correlation id are left out.
    """
    low, high = F.min("ns_subsidiary_id"), F.max("ns_subsidiary_id")
    groups = (
        transactions.where(F.col("correlation_guid").isNotNull())
        .groupBy("correlation_guid")
        .agg(
            F.coalesce(low == high, F.lit(False)).alias("one_subsidiary"),
            low.alias("subsidiary_id"),
            F.max("posted_at").alias("posted_at"),
            F.count(F.lit(1)).alias("transactions"),
        )
    )
    ok = F.col("one_subsidiary")
    return groups.select(
        "correlation_guid",
        F.when(ok, ACCEPTED).otherwise(REJECTED).alias("status"),
        F.when(~ok, MIXED_SUBSIDIARY).alias("error"),
        F.when(ok, F.col("subsidiary_id")).alias("subsidiary_id"),
        local_to_utc(F.col("posted_at"), zone).alias("transaction_at"),
        F.concat(F.lit(ENTRY_MEMO), F.lit(created_at)).alias("memo"),
        "transactions",
    )


def journal_lines(transactions: DataFrame, entries: DataFrame) -> DataFrame:
    """Credit and debit lines of the accepted entries, one row each.

    A transaction gives a credit line, a debit line or both, by which amounts
    are not zero. Lines stay rows: a group of any size is never packed into one
    value. `entries` is unique per group, so the join can split a hot group.
    """
    accepted = entries.where(F.col("status") == ACCEPTED).select("correlation_guid")
    amount = lambda c: F.coalesce(c, F.lit(0))
    credit, debit = amount(F.col("credit_amount")), amount(F.col("debit_amount"))
    none = F.lit(None)

    def line(credit_amount, debit_amount, side):
        return F.struct(
            F.lit(side).alias("side"),
            credit_amount.cast("decimal(18,2)").alias("credit"),
            debit_amount.cast("decimal(18,2)").alias("debit"),
        )

    sides = F.array_compact(
        F.array(F.when(credit != 0, line(credit, none, 1)), F.when(debit != 0, line(none, debit, 2)))
    )
    return (
        join_unique(transactions, accepted, ["correlation_guid"], "left_semi")
        .withColumn("line", F.explode(sides))
        .select(
            "correlation_guid",
            F.coalesce(F.col("ns_account_internal_id").cast("long"), F.lit(0)).alias("account_id"),
            F.col("line.side").alias("side"),
            F.col("line.credit").alias("credit"),
            F.col("line.debit").alias("debit"),
            F.concat(F.lit(LINE_MEMO), F.col("correlation_guid").cast("string")).alias("memo"),
        )
    )


def tally(entries: DataFrame) -> DataFrame:
    """Succeeded and failed entries of a run."""
    return entries.groupBy("status").agg(F.count(F.lit(1)).alias("entries"))
