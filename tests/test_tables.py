import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.errors import INPUT_ERRORS
from millrace.functions.semi import path
from millrace.operators import quality, wide
from millrace.operators.typed import DETAIL_SPEC, parse_spec, typed_select
from millrace.plans.bureau_response import ResponseTargets, load_commercial_responses, load_consumer_response
from millrace.session import scratch_path, scratch_schema
from millrace.sinks import tables
from millrace.sources import extract, files
from millrace.sources.layout import RESPONSE_HEAD

SPEC = parse_spec(
    """
    code    | CODE #  | varchar(3)
    n       | N       | number(38,0)
    m       | M       | number(18,2)?
    day     | DAY     | date
    at      | AT      | timestamp
    nothing |         | null
    """
)
_SOURCE = "`CODE #` string, N string, M string, DAY string, AT string"


def test_typed_columns(spark):
    df = spark.createDataFrame(
        [("abcdef", "12", "", "2024-02-30", "2024-01-02 03:04:05.678"), ("a", "x", "1.239", "2024-02-29", "later")], _SOURCE
    )
    first, second = typed_select(df, SPEC).collect()
    assert (first["code"], first["n"], first["m"], first["day"], first["nothing"]) == ("abc", 12, None, None, None)
    assert first["at"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert second["n"] is None and str(second["m"]) == "1.24" and second["at"] is None
    assert typed_select(df, SPEC).schema["n"].dataType.simpleString() == "decimal(38,0)"
    with pytest.raises(PySparkException):
        typed_select(df, SPEC, strict=True).collect()


def test_typed_columns_of_landed_rows(spark):
    from millrace.functions.semi import as_variant

    df = as_variant(spark.createDataFrame([("abcdef", "12", "3", "2024-02-29", None)], _SOURCE))
    row = typed_select(df, SPEC, read=lambda name: path("fields", name)).first()
    assert (row["code"], int(row["n"]), row["day"]) == ("abc", 12, dt.date(2024, 2, 29))


def test_spec_errors(spark):
    with pytest.raises(ValueError):
        typed_select(spark.range(1), parse_spec("a | id | blob"))
    assert len(DETAIL_SPEC) == 46
    kinds = [c.kind.split("(")[0] for c in DETAIL_SPEC]
    assert (kinds.count("varchar"), kinds.count("number"), kinds.count("null")) == (39, 5, 1)


def test_csv_with_quotes_and_newlines(spark, rows):
    place = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, 'a "b", c\nd', ""), (2, "", " x ")], "id int, a string, b string")
    files.write_csv(df, place)
    back = files.read_csv(spark, place, df.schema, newlines_in_values=True)
    assert rows(back) == rows(df)
    nulls = files.read_csv(spark, place, df.schema, newlines_in_values=True, keep_empty=False)
    assert nulls.where("a is null").count() == 1


def test_commercial_csv_bytes(spark):
    place = scratch_path(spark, "csv")
    df = spark.createDataFrame([("m_1", "A, B", "", 'say "x"')], "reference_number string, name string, fax string, q string")
    files.write_csv(df.coalesce(1), place, line_sep="\r\n")
    from pathlib import Path

    (part,) = Path(place).glob("part-*")
    assert part.read_bytes() == b'reference_number,name,fax,q\r\nm_1,"A, B",,"say ""x"""\r\n'


def test_file_listing(spark):
    place = scratch_path(spark, "inbox")
    for name in ("resp.risk.csv", "resp.dv.csv", "other.csv"):
        spark.range(1).write.parquet(f"{place}/{name}")
    listed = files.list_files(spark, f"{place}/resp*", "part-")
    names = listed.withColumn("name", F.col("path"))
    targets = {r["target"] for r in files.route_files(names, "risk", "comm", "cons").collect()}
    assert targets == {"comm", "cons"}
    assert files.responses_ready(listed) and not files.responses_ready(listed, listed.count() + 1)


def test_describe_drops_denied_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id int, language string")
    assert files.describe(df, denied=["language"]) == ["id"]
    assert files.describe(df, denied_types=["int"]) == ["language"]


def test_extract_rules():
    every = ["Id", "SystemModstamp", "LastModifiedDate", "CreatedDate"]
    assert extract.watermark_column("Account", every) == "SystemModstamp"
    assert extract.watermark_column("AccountHistory", every) == "CreatedDate"
    assert extract.watermark_column("AccountShare", every) == "LastModifiedDate"
    assert extract.watermark_column("AccountHistory", ["Id", "LastModifiedDate"]) == "LastModifiedDate"
    assert extract.watermark_column("Account", ["Id", "CreatedDate"]) == "CreatedDate"
    parents = {
        "Loan__History": "Loan__c", "Loan__Share": "Loan__c", "LeadFieldHistory": "Lead",
        "LeadHistory": "Lead", "LeadShare": "Lead", "Lead": None,
    }
    assert {n: extract.parent_object(n) for n in parents} == parents
    fields = [("Id", "id"), ("Language", "text"), ("Home", "address")]
    assert extract.usable_fields("Lead", fields) == ["Id"]
    assert extract.usable_fields("Account", fields) == ["Id", "Language"]


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", False)], "Id int, Name string, Test boolean")
    df = df.selectExpr("*", "timestamp'2024-01-01' + make_dt_interval(Id) as SystemModstamp")
    mark = dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc)
    got = extract.extract_rows(df, ["Id", "Name"], "SystemModstamp", mark, ["not Test"])
    assert got.columns == ["Id", "Name"] and [r["Id"] for r in got.collect()] == [3]
    assert extract.extract_rows(df, ["Id"], "SystemModstamp").count() == 3
    assert (extract.range_count(2_000_001), extract.range_count(2_000_000), extract.range_count(9, 5, 4)) == (9, 1, 3)


def test_append_keeps_new_columns(spark, rows):
    table = f"{scratch_schema(spark, 'grow')}.t"
    tables.append_table(spark.createDataFrame([(1, "a")], "id int, a string"), table)
    tables.append_table(spark.createDataFrame([(2, 5, "b")], "id int, `new one` int, A string"), table)
    tables.append_table(spark.createDataFrame([(3,)], "id int"), table)
    assert rows(spark.table(table)) == sorted([(1, "a", None), (2, "b", 5), (3, None, None)], key=repr)


def test_csv_by_name(spark):
    place = scratch_path(spark, "csv")
    spark.createDataFrame([("b1", "a1", "")], "b string, a string, c string").write.option("header", True).csv(place)
    assert tuple(files.read_csv_by_name(spark, place, ["a", "b", "c"]).first()) == ("a1", "b1", "")
    with pytest.raises(INPUT_ERRORS):
        files.read_csv_by_name(spark, place, ["a", "missing"]).collect()
    torn = scratch_path(spark, "csv")
    spark.createDataFrame([("a,b",), ("1",), ("2,3",)], "value string").coalesce(1).write.text(torn)
    with pytest.raises(INPUT_ERRORS):
        files.read_csv_by_name(spark, torn, ["a"]).collect()

def test_wide_parts(spark, rows):
    names = ["Id", "at", *[f"c{i}" for i in range(250)]]
    parts = wide.part_columns(names, ["Id", "at"])
    assert len(parts) == 16 and all(p[:2] == ["Id", "at"] for p in parts)
    assert sorted(c for p in parts for c in p[2:]) == sorted(names[2:])
    assert wide.part_columns(names[:150], ["Id"]) == [names[:150]]
    df = spark.range(500).selectExpr("id as Id", "id % 7 as a", "id * 2 as b", "cast(id as string) as c")
    small = wide.part_columns(df.columns, ["Id"], parts=3, threshold=1)
    written = wide.write_parts(df, f"{scratch_schema(spark, 'wide')}.t", ["Id"], small, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = wide.rejoin_parts(spark, written, ["Id"])
        assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
        assert rows(whole.select(df.columns)) == rows(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_land_tables(spark):
    schema = scratch_schema(spark, "land")
    load = lambda n: lambda: spark.range(n)
    tables.land_tables(spark, {"kept": load(3)}, schema)
    report = tables.land_tables(
        spark,
        {"kept": load(0), "full": load(4), "versions": load(1), "bad": lambda: spark.read.parquet("/no/such/file")},
        schema,
    )
    assert {r["table"]: (r["status"], r["rows"]) for r in report.collect()} == {
        "kept": ("empty", 0), "full": ("loaded", 4), "versions": ("skipped", None), "bad": ("failed: PATH_NOT_FOUND", None),
    }
    broken = scratch_path(spark, "broken")
    spark.range(3).coalesce(1).write.parquet(broken)
    from pathlib import Path

    for part in Path(broken).glob("part-*"):
        part.write_bytes(b"not parquet at all, but long enough to look like a file")
    for crc in Path(broken).glob(".part-*"):
        crc.write_bytes(b"")
    again = {"broken": lambda: spark.read.schema("id long").parquet(broken), "fine": load(2)}
    states = {r["table"]: r["status"] for r in tables.land_tables(spark, again, schema).collect()}
    assert states["fine"] == "loaded" and states["broken"].startswith("failed")
    # An empty source leaves the old target.
    assert spark.table(f"{schema}.kept").count() == 3
    assert spark.table(f"{schema}.full").columns == ["fields"]


def test_append_and_dated_copy(spark, rows):
    schema = scratch_schema(spark, "app")
    assert not tables.ensure_table(spark, f"{schema}.t", "a int, b string")
    assert tables.ensure_table(spark, f"{schema}.t", "a int, b string")
    tables.append_table(spark.createDataFrame([("x", 1)], "b string, a int"), f"{schema}.t")
    assert rows(spark.table(f"{schema}.t")) == [(1, "x")]
    place = scratch_path(spark, "dated")
    for label, n in (("202101", 2), ("202102", 3), ("202101", 1)):
        tables.write_dated_copy(spark.range(n), place, label)
    counts = spark.read.parquet(place).groupBy("import_month").count()
    assert rows(counts) == [(202101, 1), (202102, 3)]


def test_table_checks(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "z", 2), (None, None, 9)], "id int, s string, parent int")
    parents = spark.createDataFrame([(1,), (2,), (2,)], "pid int")
    got = quality.table_checks(df, ["id"], ["id"], {"s": ["a"]}, {"parent": (parents, "pid")})
    assert {(r["check"], r["column"]): r["failures"] for r in got.collect()} == {
        ("not_null", "id"): 1, ("accepted_values", "s"): 1, ("unique", "id"): 1, ("relationships", "parent"): 1,
    }


def test_consumer_response_tables(spark):
    schema = scratch_schema(spark, "resp")
    line = "".join(v.ljust(w) for v, w in zip(
        ["1", "Doe", "Jo", "", "JR", "", "9" * 9, "122256", "1 rue A", "Mtl", "QC", "H3H1H1", "053020", "x", "app_1", ""],
        RESPONSE_HEAD.widths,
    ))
    place = scratch_path(spark, "in")
    spark.createDataFrame([("BHDR-EQUIFAX1",), (line,), ("BTRL-EQUIFAX1",)], "value string").write.text(place)
    targets = ResponseTargets(
        f"{schema}.raw", scratch_path(spark, "rh"), f"{schema}.staged", scratch_path(spark, "sh"), f"{schema}.public"
    )
    for _ in range(2):
        load_consumer_response(spark, place, RESPONSE_HEAD, ["unique_number"], dt.date(2021, 9, 2), targets, "now")
    raw = spark.table(targets.raw).first()
    assert raw["sin"] == raw["last_name"] == raw["city"] == "" and raw["suffix"] == "JR"
    assert spark.table(targets.staged).first()["unique_number"] == dt.date(2020, 5, 30)
    public = spark.table(targets.public)
    assert public.columns[:5] == ["import_month", "accountid", "contractid", "business_name", "import_ts"]
    # The public table is appended to; the dated copy of a month is replaced.
    assert public.count() == 2 and spark.read.parquet(targets.raw_history).count() == 1


def test_a_table_by_ddl_refuses_long_text(spark, rows):
    table = f"{scratch_schema(spark, 'ddl')}.t"
    ddl = RESPONSE_HEAD.of([("a", 2), ("d", 6)]).ddl(["d"])
    good = spark.createDataFrame([("x", dt.date(2024, 1, 2))], "a string, d date")
    tables.replace_table_as(good, table, ddl)
    with pytest.raises(INPUT_ERRORS):
        tables.replace_table_as(good.withColumn("a", F.lit("long")), table, ddl)
    assert rows(spark.table(table)) == [("x", dt.date(2024, 1, 2))]
    assert dict(spark.table(table).dtypes)["d"] == "date"


def test_commercial_files_fail_alone(spark):
    schema = scratch_schema(spark, "comm")
    spec = parse_spec("n | N | number(38,0)\nimport_month | import_month | varchar(6)")
    places = {n: scratch_path(spark, n) for n in ("good", "bad", "none")}
    files.write_csv(spark.createDataFrame([("1",)], "N string"), places["good"])
    files.write_csv(spark.createDataFrame([("x",)], "N string"), places["bad"])
    files.write_csv(spark.createDataFrame([], "N string"), places["none"])
    plan = {n: (p, spec, f"{schema}.{n}") for n, p in places.items()}
    outcome = load_commercial_responses(spark, plan, dt.date(2021, 9, 2))
    assert outcome["good"] == "loaded" and outcome["none"] == "empty" and outcome["bad"].startswith("failed")
    assert tuple(spark.table(f"{schema}.good").first()) == (1, "202108")
