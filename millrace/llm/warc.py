"""WARC archives as a PySpark data source: `spark.read.format("warc")` and `df.write.format("warc")`.

Reading plans one partition per group of files, packed by size; the writer starts a new file where one grows past
`max_file_bytes`, so a partition is bounded. A record's headers are parsed first. Predicates on record type and
header columns are pushed down, and the content of a record that fails one, or whose payload the schema does not ask
for, is skipped without being decoded.

A write is committed by a manifest of its own, of the files of the tasks that succeeded; files of lost or repeated tasks
are in none and are never read. So a folder can be appended to, also by several writers at once, and may hold archives
that others wrote. Files are reached through pyarrow's file systems, so a path can be any URI these know.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from millrace.llm.common import prepare, table
from millrace.operators.joins import join_unique
from millrace.session import materialize, scratch_path

VERSION = "WARC/1.1"
MANIFEST = "_manifest"
_OWN = "millrace-"
MAX_FILE_BYTES = 64 << 20
PARTITION_BYTES = 128 << 20
MIN_REVISIT_BYTES = 100
# Broadcast the first copies of payloads only up to so many rows of about 100 bytes.
MAX_BROADCAST = 200_000
_BATCH_BYTES = 4 << 20
_SKIP = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Column, header: the header columns of a record.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in HEADERS]
    + [T.StructField("payload_length", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]

    def __init__(self, paths: tuple[str, ...]):
        super().__init__(paths)
        self.paths = paths


@dataclass
class Written(WriterCommitMessage):
    paths: tuple[str, ...]


def _header_lines(stream) -> dict[str, str] | None:
    """The next record's headers, by lower-case name; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers


def _skip(stream, n: int) -> None:
    while n > 0:
        read = len(stream.read(min(n, _SKIP)))
        if not read:
            raise EOFError("a WARC record ends too early")
        n -= read


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise EOFError("a WARC record ends too early")
    return data


def _http_end(stream, most: int) -> tuple[int, int | None]:
    """Bytes of the HTTP headers at the begin of a block, and the Content-Length they state."""
    used, length = 0, None
    while used < most:
        line = stream.readline(most - used)
        if not line:
            raise EOFError("a WARC record ends too early")
        used += len(line)
        if line in (b"\r\n", b"\n"):
            break
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            length = int(value)
    return used, length


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.columns = schema.fieldNames()
        if unknown := set(self.columns) - set(SCHEMA.fieldNames()):
            raise ValueError(f"a WARC record has no {sorted(unknown)}")
        self.schema = pa.schema([(c, {"payload": pa.binary(), "payload_length": pa.int64()}.get(c, pa.string())) for c in self.columns])
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kept = {EqualTo: "=", In: "in", StringStartsWith: "starts", IsNull: "null", IsNotNull: "set"}.get(type(f))
            if name in HEADERS and kept:
                value = getattr(f, "value", None)
                self.tests.append((HEADERS[name].lower(), kept, tuple(value) if kept == "in" else value))
            else:
                yield f

    def partitions(self):
        """Whole files in groups of about `partition_bytes`; a larger file is alone."""
        system, folder = _open(self.path)
        files = [f for f in system.get_file_info(pafs.FileSelector(folder)) if f.is_file]
        manifests = [f for f in files if f.base_name.startswith(MANIFEST)]
        files = [f for f in files if f.base_name.endswith((".warc", ".warc.gz"))]
        if manifests:
            committed: set[str] = set()
            for listed in manifests:
                with system.open_input_stream(listed.path) as stream:
                    committed.update(json.loads(stream.read()))
            files = [f for f in files if f.base_name in committed]
        groups, size = [], self.most + 1
        for f in sorted(files, key=lambda f: f.base_name):
            if size + f.size > self.most:
                groups.append([])
                size = 0
            groups[-1].append(f"{self.path}/{f.base_name}")
            size += f.size
        return [Files(tuple(g)) for g in groups] or [Files(())]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, test, value in self.tests:
            own = headers.get(name)
            if test == "null":
                ok = own is None
            elif test == "set":
                ok = own is not None
            else:
                ok = own is not None and (
                    own == value if test == "=" else own in value if test == "in" else own.startswith(value)
                )
            if not ok:
                return False
        return True

    def _record(self, stream, headers: dict[str, str], length: int) -> dict:
        row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
        http = headers.get("content-type", "").startswith("application/http")
        need = {"payload", "payload_length"} & set(self.columns)
        if not need:
            _skip(stream, length)
            return row
        used, stated = _http_end(stream, length) if http else (0, None)
        row["payload_length"] = length - used
        if row["record_type"] == "revisit":
            row["payload_length"] = stated
            _skip(stream, length - used)
        elif "payload" in need:
            row["payload"] = _exactly(stream, length - used)
        else:
            _skip(stream, length - used)
        return row

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.paths:
            system, inner = _open(path)
            with system.open_input_stream(inner, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, _SKIP)
                while (headers := _header_lines(stream)) is not None:
                    length = int(headers["content-length"])
                    if not self._wanted(headers):
                        _skip(stream, length)
                        continue
                    rows.append(self._record(stream, headers, length))
                    held += 300 + len(rows[-1].get("payload") or b"")
                    if held >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, self.schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


def _line(name: str, value: str | None) -> str:
    """One header line; line breaks in a value become spaces, so that a value cannot add a header."""
    return "" if value is None else f"{name}: {' '.join(value.splitlines())}\r\n"


def record_bytes(row: dict) -> bytes:
    """One record: headers, an HTTP response, and the payload unless the record is a revisit."""
    payload = b"" if row["record_type"] == "revisit" else row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_length']}\r\n\r\n".encode()
    head = f"{VERSION}\r\n" + "".join(_line(h, row[c]) for c, h in HEADERS.items())
    if row["record_type"] == "revisit":
        head += _line("WARC-Profile", _PROFILE)
    head += f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http) + len(payload)}\r\n\r\n"
    return b"".join((head.encode(), http, payload, b"\r\n\r\n"))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("max_file_bytes", MAX_FILE_BYTES))
        self.gzip = options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        names: list[str] = []
        stream, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if stream is None:
                        names.append(f"{_OWN}{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}")
                        stream, size = system.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    data = record_bytes(row)
                    data = gzip.compress(data, 1, mtime=0) if self.gzip else data
                    stream.write(data)
                    size += len(data)
                    if size >= self.most:
                        stream.close()
                        stream = None
        finally:
            if stream is not None:
                stream.close()
        return Written(tuple(names))

    def commit(self, messages) -> None:
        """Each write has a manifest of its own, so that writers, one after the other or at once, add to a folder.

        The first one also lists the archives that others had put there.
        """
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        names = [n for m in messages if m for n in m.paths]
        there = [f.base_name for f in system.get_file_info(pafs.FileSelector(folder)) if f.is_file]
        if not any(n.startswith(MANIFEST) for n in there):
            names += [n for n in there if n.endswith((".warc", ".warc.gz")) and not n.startswith(_OWN)]
        with system.open_output_stream(f"{folder}/{MANIFEST}-{uuid.uuid4().hex}") as stream:
            stream.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        system, folder = _open(self.path)
        for name in (n for m in messages if m for n in m.paths):
            system.delete_file(f"{folder}/{name}")


class WarcDataSource(DataSource):
    """Options: path; reading: partition_bytes; writing: max_file_bytes, compression (gzip or none)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("WARC files are never replaced; append, or write to a new folder")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to the session, and let Spark push predicates into it."""
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records below `path`. Payloads are only decoded if `columns` has `payload` (all columns, if not given).

    Call it anew for each set of predicates: Spark 4.1 keeps those it has pushed down with the loaded relation, and a
    second query on the same DataFrame without predicates of its own would be read with the first one's.
    """
    fields = [f for f in SCHEMA.fields if columns is None or f.name in columns]
    return register(spark).read.format("warc").schema(T.StructType(fields)).load(path)


def page_urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def _page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def records_of(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One record per page. Of equal payloads of `MIN_REVISIT_BYTES` or more, the smallest page's is the response.

    A null html is an empty payload; smaller payloads are always responses. Rows that repeat the smallest page are
    responses too; a null key never is the first unless all are null. Only payloads that several pages share take
    part in the join.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("long").alias("page"), F.col(url).alias("target_uri"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_length"), F.sha2(payload, 256).alias("sha"),
    )
    large = rows.where(F.col("payload_length") >= MIN_REVISIT_BYTES)
    shared = large.groupBy("sha").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.where((F.col("n") > 1) & (F.col("first") < F.col("last"))).select("sha", "first"), "copies")
    if shared.count() <= MAX_BROADCAST:
        rows = rows.join(F.broadcast(shared), "sha", "left")
    else:
        rows = join_unique(rows, shared, ["sha"], "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        page_urn(F.col("page")).alias("record_id"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha256:"), "sha").alias("payload_digest"),
        F.when(again, page_urn(F.col("first"))).alias("refers_to"),
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    path = scratch_path(spark, "warc")
    records_of(table(spark, folder, "pages")).write.format("warc").mode("append").save(path)
    responses = read_warc(spark, path).where(F.col("record_type") == "response")
    headers = [c for c in SCHEMA.fieldNames() if c != "payload"]
    revisits = read_warc(spark, path, headers).where(F.col("record_type") == "revisit")
    read = responses.select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", "refers_to",
    ).unionByName(
        revisits.select(
            "record_id", F.col("payload_length").alias("payload_bytes"), F.expr("substring(payload_digest, 8)").alias("payload_digest"),
            "record_type", "refers_to",
        )
    )
    return read.select(
        _page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        _page_of(F.col("refers_to")).alias("refers_to"),
    )


_SQL = """
with pages_of as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as sha from pages),
firsts as (select *, min(page_id) over (partition by sha) as first from pages_of)
select page_id, n::bigint as payload_bytes, sha as payload_digest,
  case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id <> first then first end as refers_to
from firsts
"""

QUERIES = {"op1_warc": op1_warc}
CHECKS = {"op1_warc": _SQL}
