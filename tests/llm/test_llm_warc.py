"""WARC archives: exact round trips, pushed predicates, and records read by plain code."""

import gzip
import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.session import scratch_path

BIG = "<p>" + "é" * 200 + "</p>"
PAGES = [
    (3, "http://a/1", BIG), (1, "http://a/2", BIG), (2, None, BIG), (4, "http://b/\r\nWARC-Type: evil", "small"), (5, "u", "small"),
    (6, "v", None), (7, "w", ""), (8, "x", "\r\n\r\nWARC/1.1\r\n" * 20), (9, "y", "z" * 3_000_000), (10, "z", "é" * 49),
    (11, "z", "é" * 50), (12, "z", "é" * 50), (13, "z", "é" * 50), (13, "z", "é" * 50), (None, "n", "unique " * 30), (-4, "m", "q" * 100), (20, "m", "q" * 100),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as sha", "2 as first", "3 as payload")


@pytest.fixture(scope="module", params=["gzip", "none"])
def archive(spark, request):
    warc.register(spark)
    path = scratch_path(spark, "warc")
    records = warc.records_of(pages(spark)).repartition(3)
    records.write.format("warc").mode("append").option("compression", request.param).option("max_file_bytes", 2000).save(path)
    return path


def test_round_trip(spark, archive):
    rows = warc.read_warc(spark, archive).collect()
    assert len(rows) == len(PAGES)
    html = {p: h or "" for p, _, h in PAGES}
    for r in rows:
        if r["record_type"] == "response":
            digest = hashlib.sha256(r["payload"]).hexdigest()
            assert r["payload_digest"] == f"sha256:{digest}" and r["payload_length"] == len(r["payload"])
            page = r["record_id"] and int(r["record_id"][10:-1])
            assert bytes(r["payload"]).decode() == html[page]
    revisits = {(r["record_id"], r["refers_to"]) for r in rows if r["record_type"] == "revisit"}
    pairs = [(2, 1), (3, 1), (12, 11), (13, 11), (20, -4)]
    assert revisits == {(f"<urn:page:{a}>", f"<urn:page:{b}>") for a, b in pairs}
    assert all(r["payload"] is None and r["payload_length"] == len(html[int(r["record_id"][10:-1])].encode()) for r in rows if r["record_type"] == "revisit")
    assert "http://b/ WARC-Type: evil" in {r["target_uri"] for r in rows}


def test_predicates_are_pushed_down(spark, archive):
    def rows(where):
        return warc.read_warc(spark, archive, ["record_type", "target_uri"]).where(where)

    some = rows((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http") & F.col("target_uri").isNotNull())
    assert [r["target_uri"] for r in some.collect()] == ["http://a/1"]
    assert rows(F.col("target_uri").isin("u", "v", "none")).count() == 2
    assert rows(F.col("target_uri").isNull()).count() == 1
    assert rows((F.col("record_type") == "revisit") | (F.col("target_uri") == "u")).count() == 7
    reader = warc.WarcReader(warc.SCHEMA, {"path": archive})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 5)]))
    assert len(left) == 1 and reader.tests == [("warc-type", "=", "revisit")]


def committed(folder):
    return [n for p in Path(folder).glob(f"{warc.MANIFEST}*") for n in json.loads(p.read_text())]


def test_only_committed_files_are_read(spark, archive):
    names = committed(archive)
    assert len(names) > 3 and {p.name for p in Path(archive).glob("*.warc*")} == set(names)
    lost = Path(archive, "0-lost.warc")
    lost.write_bytes(b"not a record")
    assert warc.read_warc(spark, archive).count() == len(PAGES)
    lost.unlink()


def test_records_are_plain_warc(spark, archive):
    """Every record has the headers it needs and a block of the stated length."""
    name = committed(archive)[0]
    data = Path(archive, name).read_bytes()
    data = gzip.decompress(data) if name.endswith(".gz") else data
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        assert lines[0] == b"WARC/1.1" and {b"WARC-Type", b"WARC-Date"} <= set(fields)
        n = int(fields[b"Content-Length"])
        assert rest[:n].startswith(b"HTTP/1.1 200 OK\r\n") and rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]


def test_foreign_records(spark):
    folder = Path(scratch_path(spark, "foreign"))
    folder.mkdir(parents=True)
    block = b"HTTP/1.0 404 Not Found\nX: y\n\nbody"
    record = b"WARC/1.0\nWARC-Type: %s\nContent-Type: %s\nContent-Length: %d\n\n%s\n\n"
    data = record % (b"warcinfo", b"application/warc-fields", 4, b"a: b") + record % (b"response", b"application/http", len(block), block)
    (folder / "x.warc").write_bytes(data)
    rows = {r["record_type"]: r for r in warc.read_warc(spark, str(folder)).collect()}
    assert bytes(rows["warcinfo"]["payload"]) == b"a: b" and bytes(rows["response"]["payload"]) == b"body"
    (folder / "y.warc").write_bytes(data[:-8])
    with pytest.raises(Exception, match="too early"):
        warc.read_warc(spark, str(folder)).collect()


def test_appends_add_up(spark):
    """Two writes one after the other, two at once, and archives of others before the first."""
    warc.register(spark)
    path = scratch_path(spark, "appended")
    Path(path).mkdir(parents=True)
    (Path(path) / "theirs.warc").write_bytes(b"WARC/1.0\nWARC-Type: warcinfo\nContent-Type: a/b\nContent-Length: 1\n\nx\n\n")

    def write(page):
        warc.records_of(pages(spark, [(page, "u", f"page {page}")])).write.format("warc").mode("append").save(path)

    write(1)
    write(2)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, (3, 4)))
    rows = warc.read_warc(spark, path).collect()
    expected = [None, *(f"<urn:page:{n}>" for n in (1, 2, 3, 4))]
    assert sorted((r["record_id"] for r in rows), key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    warc.register(spark)
    path = scratch_path(spark, "warc")
    warc.records_of(pages(spark, [])).write.format("warc").mode("append").save(path)
    assert warc.read_warc(spark, path).count() == 0


def test_join_and_broadcast_agree(spark, monkeypatch):
    few = sorted(map(repr, warc.records_of(pages(spark)).collect()))
    monkeypatch.setattr(warc, "MAX_BROADCAST", -1)
    assert sorted(map(repr, warc.records_of(pages(spark)).collect())) == few
