"""Appends whose columns change their type: a new version of the table's schema, and casts at read.

The order of types is byte, short, int, long, decimal, double, text; dates widen to timestamps, anything else to text.
A wider value opens a new version: the stored rows stay as `<table>__v1`, new ones go to `<table>__v2`, and `<table>`
becomes a view that casts all versions to the widest types. No stored row is written again. A widening that would change
a value (a long beyond 2**53 as double) fails the load, and the table stays as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.tables import append_table

_COUNT = "millrace.versions"
# Decimal digits of whole numbers, in the order of their types.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type in the order that holds the values of both."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, T.FractionalType) and not isinstance(a, T.DecimalType) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        scale = max(getattr(t, "scale", 0) if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[type(t)] for t in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.StringType) and isinstance(b, T.StringType):
        return T.StringType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times) and (isinstance(a, T.DateType) or isinstance(b, T.DateType)):
        return b if isinstance(a, T.DateType) else a
    if not all(isinstance(t, T.AtomicType) and not isinstance(t, (T.VariantType, T.BinaryType)) for t in (a, b)):
        raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def _changed(name: str, given: T.DataType, to: T.DataType) -> Column | None:
    """Whether the cast of a value changes it; None where no cast of these types does."""
    exact = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType, T.NullType)
    if not isinstance(to, T.DoubleType) or isinstance(given, exact):
        return None
    # The text of a double has the fewest digits that name it, so as a decimal it is the value again or another one.
    value, exact_type = F.col(f"`{name}`"), given if isinstance(given, T.DecimalType) else T.DecimalType(20, 0)
    back = value.cast("double").cast("string").try_cast(exact_type)
    return value.isNotNull() & ~F.coalesce(back == value.cast(exact_type), F.lit(False))


def _cast(df: DataFrame, to: dict[str, T.DataType], refuse: bool = True) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(f"`{field.name}`"), to[field.name.lower()]
        bad = _changed(field.name, field.dataType, kind) if refuse else None
        if field.dataType != kind:
            value = value.cast(kind)
        if bad is not None:
            value = F.when(bad, F.raise_error(F.lit(f"{field.name}: not the same as {kind.simpleString()}"))).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _versions(spark: SparkSession, table: str) -> int:
    """How many versions a table has; 0 if it is a plain table."""
    if spark.catalog.getTable(table).tableType != "VIEW":
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _COUNT).first()["value"])


def _show(spark: SparkSession, table: str, count: int) -> None:
    """Put the view over all versions in place; readers see it whole or not at all."""
    parts = [spark.table(f"{table}__v{i}").schema for i in range(1, count + 1)]
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for field in (f for part in parts for f in part.fields):
        key = field.name.lower()
        names.setdefault(key, field.name)
        types[key] = wider(types.get(key, field.dataType), field.dataType)
    selects = []
    for i, part in enumerate(parts, 1):
        held = {f.name.lower() for f in part.fields}
        cells = [f"CAST({f'`{n}`' if k in held else 'NULL'} AS {types[k].simpleString()}) AS `{n}`" for k, n in names.items()]
        selects.append(f"SELECT {', '.join(cells)} FROM {table}__v{i}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_COUNT}' = '{count}') AS {' UNION ALL '.join(selects)}")


def append_widening(df: DataFrame, table: str) -> None:
    """Append by column name; a column whose values need a wider type than the stored one gets it.

    Columns that the table lacks are added, and those that `df` lacks are null, as by `append_table`. Narrower values are
    cast to the stored type. The table is made on first use. A run that died before the view was in place left the old
    rows as version one; they get their name back here, and the rows of that run are written again.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        if not spark.catalog.tableExists(f"{table}__v1"):
            df.write.saveAsTable(table)
            return
        spark.sql(f"ALTER TABLE {table}__v1 RENAME TO {table}")
    count = _versions(spark, table)
    stored = {f.name.lower(): f for f in spark.table(table).schema.fields}
    target = {f.name.lower(): f.dataType for f in df.schema.fields}
    for key in target.keys() & stored.keys():
        target[key] = wider(stored[key].dataType, target[key])
    widened = [stored[k].name for k in target if k in stored and stored[k].dataType != target[k]]
    rows = _cast(df, target)
    if not widened:
        append_table(rows, f"{table}__v{count}" if count else table)
        if count:
            _show(spark, table, count)
        return
    tests = [t for t in (_changed(n, stored[n.lower()].dataType, target[n.lower()]) for n in widened) if t is not None]
    for test in tests:
        if not spark.table(table).where(test).isEmpty():
            raise ValueError(f"{table}: stored values would change in a wider type")
    fresh = max(count, 1) + 1
    # All columns of the table, so that the newest version has the widest type of each.
    every = {**{k: f.dataType for k, f in stored.items()}, **target}
    given = {c.lower() for c in rows.columns}
    rows = rows.select("*", *[F.lit(None).cast(t).alias(stored[k].name) for k, t in every.items() if k not in given])
    spark.sql(f"DROP TABLE IF EXISTS {table}__v{fresh}")
    rows.write.saveAsTable(f"{table}__v{fresh}")
    if not count:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__v1")
    _show(spark, table, fresh)


def drop_versions(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    count = _versions(spark, table)
    spark.sql(f"DROP {'VIEW' if count else 'TABLE'} {table}")
    for i in range(1, count + 1):
        spark.sql(f"DROP TABLE {table}__v{i}")
