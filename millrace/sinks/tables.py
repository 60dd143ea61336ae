"""Catalog tables: replace, append, dated copies, landing of many tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import INPUT_ERRORS, failure
from millrace.functions.semi import as_variant

# Tables that are never landed.
NOT_LANDED = ("versions", "job_reports", "job_statuses")


def replace_table(df: DataFrame, table: str, compression: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.saveAsTable(table)


def restore_table(spark: SparkSession, table: str) -> bool:
    """Undo a swap that was cut short; tells whether the table exists."""
    retired = f"{table}__old"
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {retired}")
        return True
    if spark.catalog.tableExists(retired):
        spark.sql(f"ALTER TABLE {retired} RENAME TO {table}")
        return True
    return False


def swap_in(spark: SparkSession, table: str, write_side: Callable[[str], None]) -> None:
    """Write `<table>__swap` and put it in the place of `table`.

    A side table left by a failed run is not trusted. The old table is only
    dropped when the new one has its name; if the driver dies in between,
    `restore_table` brings the old one back.
    """
    side, retired = f"{table}__swap", f"{table}__old"
    existed = restore_table(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {side}")
    write_side(side)
    if existed:
        spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
    spark.sql(f"ALTER TABLE {side} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {retired}")


def replace_table_as(df: DataFrame, table: str, ddl: str) -> None:
    """Replace a table by `df` under a given DDL, such as `Layout.ddl()`.

    Text longer than its varchar fails the load, and the old table stays.
    """
    spark = df.sparkSession

    def write_side(side: str) -> None:
        spark.sql(f"CREATE TABLE {side} ({ddl}) USING parquet")
        df.select(*spark.table(side).columns).write.insertInto(side)

    swap_in(spark, table, write_side)


def ensure_table(spark: SparkSession, table: str, ddl: str) -> bool:
    """Create schema and table when missing; tells whether the table was there."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    existed = spark.catalog.tableExists(table)
    if not existed:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")
    return existed


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name, creating the table on first use.

    A column that the table does not have yet is added to it, null in the rows already stored; one that `df` does
    not have is null in the new rows. A value that does not fit the stored type fails the load.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    stored = {c.lower() for c in spark.table(table).columns}
    added = [f for f in df.schema.fields if f.name.lower() not in stored]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    given = {c.lower(): c for c in df.columns}
    df.select(
        *[
            F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    ).write.insertInto(table)


def with_leading(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Constant columns in front of all others."""
    return df.select(*[v.alias(name) for name, v in values.items()], "*")


def write_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write a partitioned Parquet table, replacing only the partitions that `df` holds.

    The rebalance gathers each partition in few files and splits a hot one over
    several tasks.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_dated_copy(df: DataFrame, path: str, label: Column | str, column: str = "import_month") -> None:
    """Keep a copy per label in one partitioned table; a rerun replaces its own."""
    if isinstance(label, Column):
        write_partitions(df.withColumn(column, label), path, column)
    else:
        # One label is one folder: no row has to move.
        df.write.mode("overwrite").parquet(f"{path}/{column}={label}")


def land_tables(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame]],
    schema: str,
    as_fields: bool = True,
    skip: Sequence[str] = NOT_LANDED,
) -> DataFrame:
    """Land every source as a replaced table of `schema`; report (table, status, rows).

    A skipped or empty source leaves the old target alone, and one that cannot
    be read is reported and does not stop the others. A consistent view over
    all tables must come from the source (one snapshot or one landed folder).
    The loop is over table names; the data moves inside Spark.
    """
    report = []
    for name, load in sources.items():
        if name in skip:
            report.append((name, "skipped", None))
            continue
        target = f"{schema}.{name}"
        try:
            df = load()
            if df.isEmpty():
                report.append((name, "empty", 0))
                continue
            replace_table(as_variant(df) if as_fields else df, target)
        except INPUT_ERRORS as error:
            report.append((name, failure(error), None))
            continue
        report.append((name, "loaded", spark.table(target).count()))
    return spark.createDataFrame(report, "table string, status string, rows long")
