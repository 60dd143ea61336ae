"""Appends with wider types: old and new rows read back with their values."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from millrace.session import scratch_schema
from millrace.sinks.versions import append_widening, drop_versions, wider


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,10)", "decimal(38,10)"), ("decimal(4,1)", "decimal(5,3)", "decimal(6,3)"), ("bigint", "double", "double"),
        ("float", "int", "double"), ("decimal(9,2)", "double", "double"), ("double", "string", "string"), ("boolean", "int", "string"),
        ("date", "timestamp", "timestamp"), ("date", "string", "string"), ("decimal(38,0)", "decimal(38,30)", "double"), ("varchar(3)", "string", "string"),
    ],
)
def test_order_of_types(spark, a, b, both):
    a, b = ([f.dataType for f in T.StructType.fromDDL(f"x {t}").fields][0] for t in (a, b))
    assert wider(a, b).simpleString() == wider(b, a).simpleString() == both


def test_no_type_for_both():
    with pytest.raises(TypeError):
        wider(T.ArrayType(T.LongType()), T.LongType())


def test_widened_step_by_step(spark, rows):
    table = f"{scratch_schema(spark, 'wide')}.t"
    load = lambda data, schema: append_widening(spark.createDataFrame(data, schema), table)
    load([(1, "a")], "k int, v string")
    load([(2**40, "b")], "k bigint, V string")
    load([(3, "c", True)], "k int, v string, more boolean")  # narrower, and a new column
    assert rows(spark.table(table)) == [(1, "a", None), (2**40, "b", None), (3, "c", True)]
    load([(0.5,), (None,)], "k double")
    assert spark.table(table).schema["k"].dataType == T.DoubleType()
    load([("text", 4)], "k string, more int")
    # Each version is cast from the type it was stored with.
    assert rows(spark.table(table).select("k", "v", "more")) == sorted(
        [("1", "a", None), (str(2**40), "b", None), ("3", "c", "true"), ("0.5", None, None), (None, None, None), ("text", None, "4")], key=repr
    )
    drop_versions(spark, table)
    assert not spark.catalog.listTables(table.split(".")[0])


def test_a_value_that_would_change_fails(spark, rows):
    table = f"{scratch_schema(spark, 'wide')}.t"
    append_widening(spark.createDataFrame([(2**53 + 1,)], "k bigint"), table)
    with pytest.raises(ValueError, match="would change"):
        append_widening(spark.createDataFrame([(0.5,)], "k double"), table)
    assert rows(spark.table(table)) == [(2**53 + 1,)]
    other = f"{table}2"
    append_widening(spark.createDataFrame([(0.5,)], "k double"), other)
    append_widening(spark.createDataFrame([(2**53,)], "k bigint"), other)
    with pytest.raises(PySparkException, match="not the same"):
        append_widening(spark.createDataFrame([(2**53 + 1,)], "k bigint"), other)
    assert rows(spark.table(other)) == [(0.5,), (float(2**53),)]


def test_a_run_that_died_before_its_view(spark, rows):
    table = f"{scratch_schema(spark, 'wide')}.t"
    append_widening(spark.createDataFrame([(1,)], "k int"), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__v1")
    spark.createDataFrame([(2**40,)], "k bigint").write.saveAsTable(f"{table}__v2")
    append_widening(spark.createDataFrame([(2**40,)], "k bigint"), table)
    assert rows(spark.table(table)) == [(1,), (2**40,)]
