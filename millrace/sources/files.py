"""CSV, JSON and Parquet scans, landing of whole directories, file discovery."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.semi import as_variant


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    newlines_in_values: bool = False,
    keep_empty: bool = True,
) -> DataFrame:
    """Quoted CSV. Give a schema: inference reads the data twice.

    `newlines_in_values` makes a file unsplittable, so it is asked for, not
    assumed; `streams.read_csv_splits` reads large files of that kind. `keep_empty` keeps an empty text cell as '' instead of null.
    """
    reader = (
        spark.read.option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", newlines_in_values)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if not keep_empty:
        return df
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in texts})


def read_csv_by_name(
    spark: SparkSession, path: str, columns: Iterable[str], newlines_in_values: bool = False
) -> DataFrame:
    """The named columns of a quoted CSV with a header, as text, whatever their order in the file.

    A missing column is an error when the file is opened; a line with more or
    fewer cells than the header is one when it is read. An empty cell is ''.
    """
    every = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", newlines_in_values)
        .option("mode", "FAILFAST")
        # Otherwise only the wanted cells of a line are looked at, and a short line passes.
        .option("columnPruning", False)
        .csv(path)
    )
    return every.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, line_sep: str = "\n", header: bool = True) -> None:
    (
        df.write.option("header", header)
        .option("lineSep", line_sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON with a given schema, one object a line; of more on a line only the first is read.

    `streams.read_json_objects` reads objects that follow each other in any way.
    """
    return spark.read.schema(schema).json(path)


def audited(df: DataFrame, **values: Column | str) -> DataFrame:
    """Add constant audit columns (import time, import month, file name...)."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )


def source_file() -> Column:
    return F.col("_metadata.file_name")


def list_files(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Names, sizes and times of landed files. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").load(folder)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        "modificationTime",
    )


def responses_ready(files: DataFrame, expected: int | None = None) -> bool:
    """Exactly `expected` files have arrived, or any file when not given."""
    n = files.count()
    return n == expected if expected is not None else n > 0


def route_files(files: DataFrame, marker: str, inside: str, otherwise: str) -> DataFrame:
    """Name the target of each file by a marker in its name."""
    return files.withColumn("target", F.when(F.col("name").contains(marker), inside).otherwise(otherwise))


def describe(df: DataFrame, denied: Iterable[str] = (), denied_types: Iterable[str] = ()) -> list[str]:
    """Names of the usable columns of a source."""
    denied, denied_types = set(denied), set(denied_types)
    return [n for n, t in df.dtypes if n not in denied and t not in denied_types]
