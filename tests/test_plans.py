import datetime as dt
import json
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.semi import as_variant, path
from millrace.operators import crypto
from millrace.operators.batches import transform_batches
from millrace.plans import bureau_request, cashflow, ingest, journal
from millrace.plans.decryption import DecryptionSpec, decrypt_increment, landed_rows
from millrace.sources import calls, reports
from millrace.sources.documents import fetch_documents

KEYS = [("k1", b"0123456789abcdef"), ("k2", b"fedcba9876543210")]


def _keys(spark):
    df = spark.createDataFrame(KEYS, "name string, data_key binary")
    return df.select(F.base64(F.encode("name", "UTF-8")).alias("wrapped_key"), "data_key", "name")


def _sealed(spark, data):
    df = spark.createDataFrame(data, "id long, updated_at string, name string, value string, note string")
    keys = _keys(spark).withColumnRenamed("name", "key_name")
    df = df.join(keys, df["name"] == keys["key_name"])

    def sealed(c):
        nonce = F.substring(F.unhex(F.md5(F.concat(F.lit(c), "id", "updated_at"))), 1, 12)
        return crypto.seal(F.col(c), F.unbase64("wrapped_key"), F.col("data_key"), nonce)

    return df.select(
        "id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), F.col("name").alias("key"),
        sealed("value").alias("encrypted_value"), sealed("note").alias("encrypted_note"),
    )


def test_decrypt_round_trip(spark):
    df = _sealed(spark, [(1, "2024-01-01", "k1", "é", None), (2, "2024-01-01", "k2", "", "n")])
    plain = crypto.decrypt_columns(df, ["value", "note"], _keys(spark).drop("name"), "id")
    assert {r["id"]: (r["value"], r["note"]) for r in plain.collect()} == {1: ("é", None), 2: (None, "n")}


def test_transform_batches(spark, rows):
    df = spark.range(10)
    got = transform_batches(df, lambda pdf: pdf.assign(double=pdf["id"] * 2), "id long, double long")
    assert rows(got) == sorted([(i, 2 * i) for i in range(10)], key=repr)


def test_envelopes_that_cannot_be_opened(spark):
    df = _sealed(spark, [(i, "2024-01-01", "k2", "x", "y") for i in range(4)])
    bad = F.base64(F.encode(F.lit('{"key": "none"}'), "UTF-8"))
    wrong = F.base64(F.regexp_replace(F.unbase64("encrypted_value").cast("string"), '"data":"....', '"data":"AAAA').cast("binary"))
    value = F.when(F.col("id") == 1, wrong).when(F.col("id") == 2, bad).when(F.col("id") == 3, "$$").otherwise(F.col("encrypted_value"))
    got = crypto.decrypt_columns(df.withColumn("encrypted_value", value), ["value", "note"], _keys(spark).drop("name"), "id")
    assert {r["id"]: (r["value"], r["note"], list(r["decrypt_errors"])) for r in got.collect()} == {
        0: ("x", "y", []), 1: (None, "y", ["value: cannot be opened"]), 2: (None, "y", ["value: no data key"]),
        3: (None, "y", ["value: not an envelope"]),
    }


def test_yaml_post_processing(spark):
    text = (
        "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\n"
        "rate: !ruby/object:BigDecimal 18:0.125e1\n"
        "at: !ruby/object:ActiveSupport::TimeWithZone\n"
        "  utc: 2020-01-02 03:04:05.000000000 Z\n"
        "  zone: x\n"
        "day: 2020-01-02\n"
        "list: [1, two]\n"
    )
    df = _sealed(spark, [(1, "2024-01-01", "k1", text, "plain"), (2, "2024-01-01", "k1", None, None)])
    post = crypto.postprocessors_for(["value", "note"], ["yaml", None])
    got = crypto.decrypt_columns(df, ["value", "note"], _keys(spark).drop("name"), "id", post=post)
    by_id = {r["id"]: r for r in got.collect()}
    value = json.loads(by_id[1]["value"])
    assert value["rate"] == 1.25 and value["at"].startswith("2020-01-02 03:04:05")
    assert value["day"] == "2020-01-02" and value["list"] == [1, "two"]
    assert by_id[1]["note"] == "plain" and by_id[2]["value"] is None and by_id[2]["note"] is None
    with pytest.raises(ValueError):
        crypto.postprocessors_for(["a", "b"], ["yaml"])


def test_decrypt_increment(spark):
    spec = DecryptionSpec("core", "attributes", ("value",), None, ("k1",))
    assert spec.target == "core__attributes"
    keys = _keys(spark).drop("name")
    data = [(1, "2024-01-01", "k1", "a", ""), (2, "2024-01-01", "k1", "b", ""), (3, "2024-01-01", "k2", "c", "")]
    first_rows = landed_rows(as_variant(_sealed(spark, data)), spec)
    first = decrypt_increment(first_rows, None, spec, keys)
    assert {r["id"]: r["value"] for r in first.collect()} == {1: "a", 2: "b"}
    more = [*data, (1, "2024-01-02", "k1", "a2", ""), (4, "2024-01-02", "k1", "d", "")]
    rows_now = landed_rows(as_variant(_sealed(spark, more)), spec)
    second = decrypt_increment(rows_now, first, spec, keys)
    assert {r["id"]: r["value"] for r in second.collect()} == {1: "a2", 2: "b", 4: "d"}
    # A row that is gone from the source stays, and a second run changes nothing.
    third = decrypt_increment(rows_now.where("id <> 2"), second, spec, keys)
    assert {r["id"]: r["value"] for r in third.collect()} == {1: "a2", 2: "b", 4: "d"}


def _page(rows, dimensions, metrics, token=None):
    entries = [{"name": m} for m in metrics]
    report = {"columnHeader": {"dimensions": dimensions, "metricHeader": {"metricHeaderEntries": entries}}, "data": {"rows": rows}}
    return json.dumps({"reports": [report | ({"nextPageToken": token} if token else {}), report]})


def test_report_flatten(spark, rows):
    pages = [
        _page(
            [
                {"dimensions": ["20240102", "u1"], "metrics": [{"values": ["1"]}, {"values": ["2"]}]},
                {"dimensions": ["20240103"], "metrics": [{"values": ["3"]}]},
                {"dimensions": ["20240104", "u2"], "metrics": []},
            ],
            ["ga:date", "ga:dimension6"], ["ga:sessions"], "10000",
        ),
        _page([{"dimensions": ["u3"], "metrics": [{"values": ["4"]}]}], ["ga:dimension6"], ["ga:sessions"]),
        _page([{"dimensions": ["u4"], "metrics": [{"values": ["5"]}]}], ["ga:x"], ["ga:x"]),
        '{"reports": []}',
    ]
    df = spark.createDataFrame([(p,) for p in pages], "j string").select(F.from_json("j", reports.PAGE_SCHEMA).alias("p")).select("p.*")
    got = reports.flatten_report(df, ["dimension6", "sessions", "x"], "2024-01-31", "now")
    assert rows(got) == sorted(
        [
            ("20240102", "now", "u1", "2", None),
            ("20240103", "now", None, "3", None),
            (None, None, None, None, None),
            ("2024-01-31", "now", "u3", "4", None),
            ("2024-01-31", "now", None, None, "5"),
        ],
        key=repr,
    )
    assert rows(reports.next_page_token(df)) == [("10000",)]


def test_calls(spark, rows):
    assert calls.day_slices(spark, dt.date(2024, 1, 30), dt.date(2024, 2, 2)).count() == 3
    assert calls.day_slices(spark, dt.date(2024, 1, 30), dt.date(2024, 1, 30)).count() == 0
    text = '{"entries": [{"call_id": "a"}, {"call_id": "b"}]}'
    df = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", "entries array<struct<call_id: string>>").alias("r"))
    assert rows(calls.report_entries(df.select("r.*")).select("call.call_id")) == [("a",), ("b",)]
    embedded = '{"_embedded": {"recordings": [{"id": "r1", "_links": {"media": {"href": "u1"}}}, {"id": "r2"}]}}'
    data = [("a", embedded), ("b", None), ("c", "{}")]
    df = spark.createDataFrame(data, "id string, j string").select(
        F.struct(F.col("id").alias("call_id")).alias("call"), F.from_json("j", calls.RECORDINGS_SCHEMA).alias("recordings")
    )
    assert rows(calls.explode_recordings(df)) == [("a", "r1", "u1"), ("a", "r2", None), ("b", None, None), ("c", None, None)]


_LEDGER = (
    "correlation_guid string, posted_at timestamp_ntz, credit_amount decimal(18,2), debit_amount decimal(18,2), "
    "ns_account_internal_id int, ns_subsidiary_id int"
)


def test_journal(spark, rows):
    from decimal import Decimal as D

    early, late = dt.datetime(2020, 7, 1, 10), dt.datetime(2020, 7, 1, 12)
    df = spark.createDataFrame(
        [
            ("ok", early, D(0), D(1), 22000, 6),
            ("ok", late, D(1), D(0), 25000, 6),
            ("mixed", early, D(0), D(1), 22000, 11),
            ("mixed", early, D(1), D(0), 25000, 6),
            ("both", early, D(2), D(3), None, 7),
            ("both", early, None, None, 1, None),
            ("unknown", early, D(1), D(1), 1, None),
            (None, early, D(1), D(1), 1, 6),
        ],
        _LEDGER,
    )
    entries = journal.journal_entries(df, "2020-01-01")
    by_id = {r["correlation_guid"]: r for r in entries.collect()}
    assert {k: (r["status"], r["error"], r["subsidiary_id"]) for k, r in by_id.items()} == {
        "ok": ("accepted", None, 6),
        "mixed": ("rejected", "Different subsidiary", None),
        "both": ("accepted", None, 7),
        "unknown": ("rejected", "Different subsidiary", None),
    }
    assert by_id["ok"]["memo"] == "Platform Transaction - 2020-01-01"
    shown = entries.where("correlation_guid = 'ok'").select(F.date_format("transaction_at", "yyyy-MM-dd HH:mm")).first()[0]
    assert shown == "2020-07-01 16:00"
    lines = journal.journal_lines(df, entries)
    assert rows(lines.select("correlation_guid", "account_id", "credit", "debit")) == sorted(
        [("ok", 22000, None, D("1.00")), ("ok", 25000, D("1.00"), None), ("both", 0, D("2.00"), None), ("both", 0, None, D("3.00"))],
        key=repr,
    )
    assert lines.select("memo").distinct().count() == 2
    assert rows(journal.tally(entries)) == [("accepted", 2), ("rejected", 2)]


def _series(name, n, slope, noise):
    """A series whose balance wobbles around a line, as (series, day, balance, credits, debits)."""
    start = dt.date(2023, 1, 1)
    return [(name, start + dt.timedelta(days=i), 1000 + slope * i + noise * math.sin(i * 1.7), 10.0, 9.0) for i in range(n)]


def _ahead(name, n, step):
    start = dt.date(2024, 6, 1)
    return [(name, start + dt.timedelta(days=i), max(step, 0.0), max(-step, 0.0)) for i in range(n)]


def _band(history, projection):
    """The band and the projected balance from the textbook sums, one series at a time."""
    from millrace.functions.stats import t_quantile

    ys = [h[2] for h in history]
    n = len(ys)
    xs = list(range(1, n + 1))
    mx, my = sum(xs) / n, sum(ys) / n
    sxx = sum((x - mx) ** 2 for x in xs)
    slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sxx
    sse = sum((y - my - slope * (x - mx)) ** 2 for x, y in zip(xs, ys))
    last = n + len(projection)
    half = t_quantile(n - 2) * math.sqrt(sse / (n - 2) * (1 + 1 / n + (last - mx) ** 2 / sxx))
    middle = my + slope * (last - mx)
    balance = ys[-1] + history[-1][3] - history[-1][4]
    for p in projection[:-1]:
        balance += p[2] - p[3]
    return middle - half, balance, middle + half


def test_guardrail(spark):
    cases = {
        "inside": (_series("inside", 300, 2, 400), _ahead("inside", 42, 2.0), False),
        "above": (_series("above", 300, 2, 40), _ahead("above", 42, 500.0), True),
        "below": (_series("below", 300, 2, 40), _ahead("below", 42, -500.0), True),
        "falling": (_series("falling", 281, -3, 300), _ahead("falling", 42, -3.0), False),
        "flat_line": (_series("flat_line", 50, 1, 0), _ahead("flat_line", 42, 9.0), True),
        "short": (_series("short", 2, 2, 1), _ahead("short", 42, 0.0), True),
        "single": (_series("single", 1, 2, 1), _ahead("single", 3, 0.0), True),
    }
    history = spark.createDataFrame(
        [r for h, _, _ in cases.values() for r in h], "series_id string, date date, balance double, credits double, debits double"
    )
    projection = spark.createDataFrame(
        [r for _, p, _ in cases.values() for r in p], "series_id string, date date, credits_prediction double, debits_prediction double"
    )
    got = {r["series_id"]: r for r in cashflow.guardrail(history.repartition(3), projection).collect()}
    assert {k: r["outside"] for k, r in got.items()} == {k: c[2] for k, c in cases.items()}
    for name in ("inside", "above", "below", "falling"):
        expected = _band(*cases[name][:2])
        assert (got[name]["lower"], got[name]["projected"], got[name]["upper"]) == pytest.approx(expected, rel=1e-9)


def test_opening_and_period_balances(spark, rows):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 2, 1)]
    df = spark.createDataFrame([("a", d, 10 * i, i) for i, d in enumerate(days, 1)], "series_id string, date date, credits int, debits int")
    opened = cashflow.opening_balances(df, F.lit(100))
    assert [r["balance"] for r in opened.orderBy("date").collect()] == [100, 109, 127, 154]
    closing = cashflow.closing_balances(df, F.lit(100))
    weekly = cashflow.period_balances(closing, "week")
    assert rows(weekly.select("period_start", "balance", "change")) == sorted(
        [(dt.date(2024, 1, 1), 109, None), (dt.date(2024, 1, 8), 154, 45), (dt.date(2024, 1, 29), 190, 36)], key=repr
    )
    assert rows(cashflow.period_balances(closing, "month").select("change")) == [(36,), (None,)]


def test_eligible_loans(spark):
    data = [
        ("open", 5.0, None, "A", "open", True),
        ("recent", 0.0, "2023-06-01", "A", "closed", True),
        ("edge", 0.0, "2023-01-01", "A", "closed", True),
        ("old", 0.0, "2022-12-31", "A", "closed", False),
        ("recent_open", 0.0, "2023-06-01", "A", "repaid", False),
        ("facility", 5.0, None, "O", "open", False),
        ("no_facility", 5.0, None, None, "open", False),
        ("unknown", None, "2023-06-01", "A", "closed", True),
        ("bad_date", 0.0, "soon", "A", "closed", False),
    ]
    df = spark.createDataFrame(
        [d[:5] for d in data],
        "merchant_guid string, outstanding_balance double, fully_repaid_at string, facility_code string, state string",
    )
    got = {r["merchant_guid"] for r in bureau_request.eligible_loans(df, dt.date(2024, 1, 1)).collect()}
    assert got == {d[0] for d in data if d[5]}


def test_manual_list_of_one(spark):
    """A list with a single guid is as good as a longer one."""
    from millrace.functions.address import ADDRESS_FIELDS

    applicants = spark.createDataFrame([(1, "a1", "x"), (2, "a2", "y"), (3, "a3", "z")], "applicant_id long, applicant_guid string, encrypted_first_name string")
    attributes = spark.createDataFrame([(1, "sin", "s"), (1, "sin", "s"), (1, "sin", "t")], "applicant_id long, key string, encrypted_value string")
    links = spark.createDataFrame([(1, 7, "Individuals::Applicant", "t", "physical_address")], "party_id long, address_id long, party_type string, active string, category string")
    addresses = spark.createDataFrame([(7, *["x"] * 12)], "address_id long, " + ", ".join(f"{c} string" for c in ADDRESS_FIELDS))
    loans = spark.createDataFrame([("m1", 1.0, None, "A", "open"), ("m1", 2.0, None, "A", "open")], "merchant_guid string, outstanding_balance double, fully_repaid_at string, facility_code string, state string")
    merchants = spark.createDataFrame([("m1", "M", "a1"), ("m2", "N", "a3")], "guid string, name string, primary_applicant_guid string")
    run = lambda **more: bureau_request.consumer_request(applicants, attributes, links, addresses, loans, merchants, dt.date(2024, 1, 1), **more)
    got = run(manual_guids=["a2"])
    # Two values of one attribute give two rows; exact copies give one.
    assert [(r["id"], r["applicant_guid"], r["encrypted_sin"], r["city"]) for r in got.orderBy("id").collect()] == [
        (1, "a1", "s", "x"), (2, "a1", "t", "x"), (3, "a2", None, None),
    ]
    assert tuple(bureau_request.request_counts(got, "applicant_guid").first()) == (3, 2)
    assert {r["applicant_guid"] for r in run(manual_guids=["a2"], excluded_guids=["a1"]).collect()} == {"a2"}


def test_fetch_reports_missing_documents(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"body")
    keys = spark.createDataFrame([("x", str(tmp_path / "a.bin")), ("y", str(tmp_path / "none"))], "guid string, path string")
    got = {r["guid"]: r for r in fetch_documents(keys, "path").collect()}
    assert bytes(got["x"]["body"]) == b"body" and got["x"]["last_modified_at"] is not None and got["x"]["fetch_error"] is None
    assert got["y"]["body"] is None and "none" in got["y"]["fetch_error"]


def test_stored_documents_follow_the_plain_replace(spark, rows):
    data = [("m", "f", ' [{"a"=>"vanilla"}, {"a"=>nil}]'), ("m", "g", '{"a"=>"x"}'), ("m", "h", '[{"a"=>'), ("m", "i", None)]
    opened = spark.createDataFrame(data, "merchant_guid string, file_path string, text string")
    opened = opened.withColumn("last_modified_at", F.lit(None).cast("timestamp"))
    value = path("raw_response", "a").alias("a")
    got = ingest.stored_bank_documents(opened).select("file_path", value)
    assert rows(got) == [("f", "vanullla"), ("f", None), ("g", "x")]
    safe = ingest.stored_bank_documents(opened, safe=True).select(value)
    assert rows(safe) == [("vanilla",), ("x",), (None,)]
