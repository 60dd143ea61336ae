"""A schema lands as it was when its tables were pinned."""

import pytest

from millrace.session import scratch_schema
from millrace.sinks.snapshots import land_snapshot, pin, read_pinned, tables_of


@pytest.fixture
def schemas(spark):
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    spark.range(100).selectExpr("id", "id % 3 as part").write.partitionBy("part").saveAsTable(f"{source}.split")
    spark.range(50).selectExpr("id", "cast(id as string) as name").write.saveAsTable(f"{source}.plain")
    spark.range(0).write.saveAsTable(f"{source}.bare")
    spark.range(5).write.saveAsTable(f"{source}.versions")
    spark.sql(f"create view {source}.seen as select * from {source}.plain")
    return source, target


def test_tables_are_found(spark, schemas):
    assert tables_of(spark, schemas[0]) == ["bare", "plain", "split"]


def test_lands_as_pinned(spark, schemas):
    source, target = schemas
    tables = tables_of(spark, source)
    manifest = pin(spark, source, tables)
    spark.range(100, 130).selectExpr("id", "id % 5 as part").write.insertInto(f"{source}.split")
    spark.range(7).selectExpr("id", "'late' as name").write.insertInto(f"{source}.plain")
    report = {r["table"]: (r["status"], r["rows"]) for r in land_snapshot(spark, source, target, tables, manifest=manifest, as_fields=False).collect()}
    assert report == {"split": ("loaded", 100), "plain": ("loaded", 50), "bare": ("empty", 0)}
    landed = spark.table(f"{target}.split")
    assert landed.columns == ["id", "part"] and landed.selectExpr("sum(id)", "sum(part)").first() == (4950, 99)
    assert not spark.catalog.tableExists(f"{target}.bare")
    # A new snapshot has what came in between.
    again = {r["table"]: r["rows"] for r in land_snapshot(spark, source, target, as_fields=False).collect()}
    assert again == {"split": 130, "plain": 57, "bare": 0}


def test_replaced_table_is_reported(spark, schemas):
    source, target = schemas
    land_snapshot(spark, source, target, ["plain"])
    manifest = pin(spark, source, ["plain", "split"])
    spark.range(3).selectExpr("id", "'new' as name").write.mode("overwrite").saveAsTable(f"{source}.plain")
    report = {r["table"]: r for r in land_snapshot(spark, source, target, ["plain", "split"], manifest=manifest).collect()}
    assert report["split"]["status"] == "loaded"
    assert report["plain"]["status"] not in ("loaded", "empty") and report["plain"]["rows"] is None
    assert spark.table(f"{target}.plain").count() == 50


def test_pinned_rows(spark, schemas):
    source, _ = schemas
    manifest = pin(spark, source, ["plain"])
    assert read_pinned(spark, source, "plain", manifest).count() == 50
    assert read_pinned(spark, source, "bare", manifest).count() == 0
