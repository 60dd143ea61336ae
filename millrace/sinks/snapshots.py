"""One consistent snapshot of a schema: its tables are pinned together, then landed several at a time.

The tables are found in the catalog. Before the first is read, a manifest notes the data files of all of them, with size
and time. Each table is then read from exactly these files, so rows that arrive later are not in its copy, whenever its turn
comes. If a pinned file was replaced or is gone, that table is reported and its last copy stays. Files are noted table by
table, so writers that must be seen together have to be still for that short while.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import INPUT_ERRORS, failure
from millrace.functions.semi import as_variant
from millrace.session import scratch_path
from millrace.sinks.tables import NOT_LANDED, replace_table

_MANIFEST = "table string, file string, size long, time timestamp"


def tables_of(spark: SparkSession, schema: str, skip: Sequence[str] = NOT_LANDED) -> list[str]:
    """Names of the stored tables of a schema, views left out."""
    listed = spark.catalog.listTables(schema)
    return sorted(t.name for t in listed if not t.isTemporary and t.tableType != "VIEW" and t.name not in skip)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name").isin("Provider", "Location")).collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _files(df: DataFrame) -> DataFrame:
    """The files of a table, with size and time; only footers are read."""
    meta = F.col("_metadata")
    return df.select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("time")
    ).distinct()


def pin(spark: SparkSession, schema: str, tables: Sequence[str], path: str | None = None) -> DataFrame:
    """The manifest (table, file, size, time) of all `tables`, written before any of them is read for its rows."""
    path = path or scratch_path(spark, "manifest")
    spark.createDataFrame([], _MANIFEST).write.mode("overwrite").parquet(path)
    for name in tables:
        _files(spark.table(f"{schema}.{name}")).select(F.lit(name).alias("table"), "*").write.mode("append").parquet(path)
    return spark.read.schema(_MANIFEST).parquet(path)


def read_pinned(spark: SparkSession, schema: str, table: str, manifest: DataFrame) -> DataFrame:
    """The rows that the table had when it was pinned. A file that changed since is an error.

    The driver sees the names of the table's files, as it does for any scan.
    """
    stored = spark.table(f"{schema}.{table}")
    about = _described(spark, f"{schema}.{table}")
    pinned = manifest.where(F.col("table") == table).select("file", "size", "time")
    names = [r["file"] for r in pinned.select("file").collect()]
    if not names:
        return stored.limit(0)
    df = spark.read.schema(stored.schema).option("basePath", about["Location"]).format(about["Provider"]).load(names)
    changed = pinned.exceptAll(_files(df)).count()
    if changed:
        raise ValueError(f"{changed} files of {table} changed since they were pinned")
    return df


def land_snapshot(
    spark: SparkSession,
    source: str,
    target: str,
    tables: Sequence[str] | None = None,
    at_once: int = 4,
    as_fields: bool = True,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Land the tables of schema `source` as of one moment in schema `target`; report (table, status, rows).

    `at_once` tables are written at a time, each in a scheduler pool of its own, so that a large one does not hold up the
    small ones. An empty table leaves the old copy alone; one that cannot be read is reported and stops no other. The loop
    is over table names; the rows move inside Spark.
    """
    tables = tables_of(spark, source) if tables is None else list(tables)
    manifest = pin(spark, source, tables) if manifest is None else manifest

    def land(name: str) -> tuple[str, str, int | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"land_{name}")
        try:
            df = read_pinned(spark, source, name, manifest)
            if df.isEmpty():
                return name, "empty", 0
            replace_table(as_variant(df) if as_fields else df, f"{target}.{name}")
            return name, "loaded", spark.table(f"{target}.{name}").count()
        except (*INPUT_ERRORS, ValueError) as error:
            return name, failure(error), None
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        report = list(pool.map(land, tables))
    return spark.createDataFrame(report, "table string, status string, rows long")
