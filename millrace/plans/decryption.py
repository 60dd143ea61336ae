"""Incremental decryption of landed tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import path
from millrace.operators.crypto import decrypt_columns, postprocessors_for
from millrace.operators.incremental import not_in
from millrace.operators.upsert import keep_latest, swap_table, union_all
from millrace.session import materialize
from millrace.sinks.tables import replace_table, restore_table

LATEST_BY = ("updated_at", "_hash")


@dataclass(frozen=True)
class DecryptionSpec:
    """One landed table: its encrypted columns, their formats, and a row filter.

    `keys` limits a key/value table to the listed values of its `key` column.
    """

    schema: str
    table: str
    columns: tuple[str, ...]
    formats: str | tuple[str | None, ...] | None = None
    keys: tuple[str, ...] = ()

    @property
    def target(self) -> str:
        return f"{self.schema}__{self.table}"


def landed_rows(landed: DataFrame, spec: DecryptionSpec) -> DataFrame:
    """Typed columns of the landed VARIANT rows and their change hash."""
    if spec.keys:
        landed = landed.where(path("fields", "key").isin(list(spec.keys)))
    return landed.select(
        path("fields", "id", "long").alias("id"),
        path("fields", "updated_at", "timestamp_ntz").alias("updated_at"),
        F.sha2(F.to_json("fields"), 256).alias("_hash"),
        *[path("fields", f"encrypted_{c}").alias(f"encrypted_{c}") for c in spec.columns],
    )


def _unknown(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    return rows if existing is None else not_in(rows, existing, "_hash")


def decrypt_increment(
    rows: DataFrame, existing: DataFrame | None, spec: DecryptionSpec, keys: DataFrame
) -> DataFrame:
    """Rows of unknown hash decrypted, merged with the known ones, latest per id.

    Rows with an envelope that cannot be opened have their reasons in
    `decrypt_errors`; known rows have none. Older incoming versions lose in the end, so they go first: the hash join and
    the decryption then see one row per id, which no hot id can swell.
    """
    latest = keep_latest(rows, ["id"], LATEST_BY)
    fresh = decrypt_columns(
        _unknown(latest, existing), spec.columns, keys, "id", post=postprocessors_for(spec.columns, spec.formats)
    )
    if existing is None:
        return fresh
    known = existing.withColumn("decrypt_errors", F.array().cast("array<string>"))
    return keep_latest(union_all(fresh, known), ["id"], LATEST_BY)


def refresh_decrypted(
    landed: DataFrame, spec: DecryptionSpec, keys: DataFrame, target_schema: str
) -> str:
    """Bring the decrypted table of one landed table up to date; gives its name.

    A row that cannot be opened does not replace a stored one: it goes to
    `<table>__rejects`, written anew in each run, and is tried again in the next.
    """
    spark = landed.sparkSession
    table = f"{target_schema}.{spec.target}"
    existing = spark.table(table) if restore_table(spark, table) else None
    latest = keep_latest(landed_rows(landed, spec), ["id"], LATEST_BY)
    fresh = materialize(decrypt_increment(_unknown(latest, existing), None, spec, keys), "decrypted")
    sound = F.size("decrypt_errors") == 0
    good = fresh.where(sound).drop("decrypt_errors")
    swap_table(good if existing is None else keep_latest(union_all(good, existing), ["id"], LATEST_BY), table)
    replace_table(fresh.where(~sound).select("id", "updated_at", "_hash", "decrypt_errors"), f"{table}__rejects")
    return table
