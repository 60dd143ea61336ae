"""Every registered query against its SQL check, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from millrace.queries import registry
from tools.check import TABLES, rows_of

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, str(FOLDER))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(registry.CHECKS[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_every_query_has_a_check():
    assert set(registry.CHECKS) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_file_discovery_follows_its_table(spark):
    rows = registry.QUERIES["file_discovery"](spark, str(FOLDER)).collect()
    assert {r["target"] for r in rows} == {"comm", "cons"}
    assert sum(r["n"] for r in rows) == spark.read.parquet(f"{FOLDER}/customer.parquet").count()


def test_both_commercial_files_are_loaded(spark):
    rows = registry.QUERIES["commercial_response_load"](spark, str(FOLDER)).groupBy("target").count().collect()
    n = spark.read.parquet(f"{FOLDER}/customer.parquet").count()
    assert {r["target"]: r["count"] for r in rows} == {"detail": n, "risk": n}


def test_line_validation_meets_each_kind_of_rule(spark):
    found = {r["category"] for r in registry.QUERIES["line_validation"](spark, str(FOLDER)).select("category").distinct().collect()}
    assert {"header", "footer", "length", "sin"} <= found
