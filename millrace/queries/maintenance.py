"""Encrypted columns, wide tables, table replacement, documents, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import as_variant, path
from millrace.operators.crypto import decrypt_columns as decrypt_of
from millrace.operators.crypto import postprocessors_for, seal, text_or_null
from millrace.operators.upsert import replicate_tables, swap_table
from millrace.operators.wide import part_columns, rejoin_parts, write_parts
from millrace.plans.decryption import DecryptionSpec, refresh_decrypted
from millrace.plans.ingest import (
    open_documents,
    owned_documents,
    pending_documents,
    pending_reports,
    stored_bank_documents,
    stored_reports,
)
from millrace.plans.objects import load_object
from millrace.queries.support import Tables, key_table, query
from millrace.session import scratch_path, scratch_schema
from millrace.sinks.snapshots import land_snapshot, pin, tables_of
from millrace.sinks.tables import append_table, ensure_table, land_tables as land_of
from millrace.sinks.versions import append_widening
from millrace.sources.documents import fetch_documents
from millrace.streaming.ingest import (
    append_new_keys,
    arriving_files,
    merge_latest,
    merge_latest_files,
    replay_safe_files,
    run_available,
    tumbling_totals as totals_of,
)
from millrace.streaming.sets import arriving_names, ended_sets, load_sets


def _sealed_customers(t: Tables) -> DataFrame:
    """Customers with encrypted name and segment; a nonce per row and column."""
    keys = key_table(t)
    rows = t.customer.join(keys, F.col("c_nationkey") == F.col("n_nationkey"))

    def sealed(column: str):
        nonce = F.substring(F.unhex(F.md5(F.concat(F.lit(column), "c_custkey"))), 1, 12)
        plain = F.when(F.col("c_acctbal") >= 0, F.col(column))
        return seal(plain, F.unbase64("wrapped_key"), F.col("data_key"), nonce)

    return rows.select(
        F.col("c_custkey").alias("id"),
        F.timestamp_add("DAY", F.col("c_nationkey"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("updated_at"),
        F.col("c_mktsegment").alias("key"),
        sealed("c_name").alias("encrypted_name"),
        sealed("c_mktsegment").alias("encrypted_segment"),
    )


@query("""
    select c_custkey as id, case when c_acctbal >= 0 and c_custkey % 7 not in (1, 2) and c_nationkey <> 3 then c_name end as name,
      case when c_acctbal >= 0 and c_nationkey <> 3 then c_mktsegment end as segment,
      case when c_custkey % 7 = 2 then 'name: not an envelope;' when c_acctbal < 0 then ''
        when c_nationkey = 3 then 'name: no data key;' when c_custkey % 7 = 1 then 'name: cannot be opened;' else '' end
      || case when c_acctbal >= 0 and c_nationkey = 3 then 'segment: no data key;' else '' end as errors
    from customer
""")
def decrypt_columns(t: Tables):
    """Encrypted columns, some with a changed ciphertext, no envelope at all, or a key that is not known."""
    keys = key_table(t).where("n_nationkey <> 3").select("wrapped_key", "data_key")
    sealed = _sealed_customers(t)
    text = F.unbase64("encrypted_name").cast("string")
    changed = F.base64(F.regexp_replace(text, '"data":"....', '"data":"AAAA').cast("binary"))
    name = F.when(F.col("id") % 7 == 2, "$$").when(F.col("id") % 7 == 1, changed).otherwise(F.col("encrypted_name"))
    plain = decrypt_of(
        sealed.withColumn("encrypted_name", name), ["name", "segment"], keys, "id", post={"segment": text_or_null}
    )
    errors = F.array_join(F.transform("decrypt_errors", lambda e: F.concat(e, F.lit(";"))), "").alias("errors")
    return plain.select("id", "name", "segment", errors)


@query("""
    select c_custkey as id, case when c_acctbal >= 0 then
      '{"segment": "' || c_mktsegment || '", "nation": ' || c_nationkey || ', "limit": 12.5, "since": "2020-01-02"}'
      end as profile from customer
""")
def decrypt_yaml(t: Tables):
    """Encrypted YAML objects as JSON text."""
    rows = t.customer.join(key_table(t), F.col("c_nationkey") == F.col("n_nationkey"))
    profile = F.concat(
        F.lit("--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\nsegment: "),
        "c_mktsegment",
        F.lit("\nnation: "),
        "c_nationkey",
        F.lit("\nlimit: !ruby/object:BigDecimal 18:0.125e2\nsince: 2020-01-02\n"),
    )
    nonce = F.substring(F.unhex(F.md5(F.concat(F.lit("profile"), "c_custkey"))), 1, 12)
    plain = F.when(F.col("c_acctbal") >= 0, profile)
    sealed = rows.select(
        F.col("c_custkey").alias("id"),
        seal(plain, F.unbase64("wrapped_key"), F.col("data_key"), nonce).alias("encrypted_profile"),
    )
    keys = key_table(t).select("wrapped_key", "data_key")
    plain = decrypt_of(sealed, ["profile"], keys, "id", post=postprocessors_for(["profile"], "yaml"))
    return plain.select("id", "profile")


@query("""
    select c_custkey as id, strftime(timestamp '2024-01-01' + to_days(cast(c_nationkey as integer)), '%Y-%m-%d') as updated_on,
      case when c_acctbal >= 0 then c_name end as name
    from customer where c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')
""")
def decrypt_increment_merge(t: Tables):
    """First load of early rows, then an increment over all of them."""
    spec = DecryptionSpec("core", "customers", ("name",), None, ("BUILDING", "MACHINERY", "FURNITURE"))
    keys = key_table(t).select("wrapped_key", "data_key")
    place = scratch_path(t.spark, "sealed")
    as_variant(_sealed_customers(t).drop("encrypted_segment")).write.parquet(place)
    landed, schema = t.spark.read.parquet(place), scratch_schema(t.spark, "pii")
    early = path("fields", "updated_at", "timestamp_ntz") < F.lit("2024-01-10").cast("timestamp_ntz")
    refresh_decrypted(landed.where(early), spec, keys, schema)
    table = refresh_decrypted(landed, spec, keys, schema)
    return t.spark.table(table).select("id", F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"), "name")


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
       "cast(cast(o_orderdate as date) as varchar) as o_orderdate from orders")
def wide_split_rejoin(t: Tables):
    always = ["o_orderkey", "o_orderdate"]
    columns = part_columns(t.orders.columns, always, parts=4, threshold=1)
    table = f"{scratch_schema(t.spark, 'wide')}.orders"
    names = write_parts(t.orders, table, always, columns, buckets=8)
    whole = rejoin_parts(t.spark, names, always)
    return whole.withColumn("o_orderdate", F.to_date("o_orderdate").cast("string")).select(*t.orders.columns)


@query("""
    select o_orderkey as "Id", cast(cast(o_orderdate as date) as varchar) as stamp, o_custkey, o_orderpriority,
      case when o_orderdate >= date '1998-01-01' then o_orderstatus end as gained, '2024-02-01 00:00:00.000' as import_ts
    from orders where o_orderstatus <> 'P'
""")
def object_increment(t: Tables):
    """An object split in parts, loaded in two runs, the second with a new field, and put together again."""
    source = t.orders.withColumnsRenamed({"o_orderkey": "Id", "o_orderdate": "SystemModstamp"})
    schema, load_ts = scratch_schema(t.spark, "objects"), "2024-02-01 00:00:00.000"
    early = source.where("SystemModstamp < timestamp_ntz '1998-01-01'")
    for rows in (early, source.withColumn("gained", F.col("o_orderstatus"))):
        load_object(rows, "Loan", schema, load_ts, filters=["o_orderstatus <> 'P'"], parts=2, threshold=1)
    first, second = (t.spark.table(f"{schema}.Loan___PART_{i}") for i in range(2))
    whole = first.join(second.drop("import_ts"), ["Id", "SystemModstamp"])
    stamp = F.to_date("SystemModstamp").cast("string").alias("stamp")
    return whole.select("Id", stamp, "o_custkey", "o_orderpriority", "gained", "import_ts")


@query("""
    select n_nationkey, n_name, n_regionkey from nation
    union all select n_nationkey, n_name || '*', n_regionkey from nation
""")
def swap_replace(t: Tables):
    schema = scratch_schema(t.spark, "replica")
    t.nation.write.saveAsTable(f"{schema}.source")
    replicate_tables(t.spark, [(f"{schema}.source", f"{schema}.nation")])
    # The new content reads the table it replaces.
    old = t.spark.table(f"{schema}.nation")
    swap_table(old.unionByName(old.withColumn("n_name", F.concat("n_name", F.lit("*")))), f"{schema}.nation")
    return t.spark.table(f"{schema}.nation")


@query("""
    select 'region' as "table", 'loaded' as status, count(*) as rows from region
    union all select 'supplier', 'loaded', count(*) from supplier
    union all select 'orders', 'loaded', count(*) from orders
    union all select 'nothing', 'empty', 0
    union all select 'versions', 'skipped', null
    union all select 'absent', 'failed: PATH_NOT_FOUND', null
""")
def land_tables(t: Tables):
    return land_of(
        t.spark,
        {
            "region": lambda: t.region,
            "supplier": lambda: t.supplier,
            "orders": lambda: t.orders,
            "nothing": lambda: t.region.where("r_regionkey < 0"),
            "versions": lambda: t.orders,
            "absent": lambda: t.no_such_table,
        },
        scratch_schema(t.spark, "landed"),
    )


@query("""
    select 'customer' as name, c_custkey as key, c_name as label from customer
    union all select 'orders', o_orderkey, o_orderpriority from orders
    union all select 'supplier', s_suppkey, s_name from supplier
""")
def pinned_snapshot(t: Tables):
    """A schema lands as it was when it was pinned, though two of its tables grow before they are read."""
    source, target = scratch_schema(t.spark, "source"), scratch_schema(t.spark, "pinned")
    rows = {
        "customer": t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("label")),
        "orders": t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("label")),
        "supplier": t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("label")),
    }
    for name, df in rows.items():
        df.write.saveAsTable(f"{source}.{name}")
    manifest = pin(t.spark, source, tables_of(t.spark, source))
    for name in ("orders", "supplier"):
        rows[name].withColumn("label", F.lit("late")).write.insertInto(f"{source}.{name}")
    land_snapshot(t.spark, source, target, as_fields=False, manifest=manifest)
    landed = [t.spark.table(f"{target}.{name}").select(F.lit(name).alias("name"), "key", "label") for name in rows]
    return landed[0].union(landed[1]).union(landed[2])


@query("""
    select s_suppkey, s_name from supplier
    union all select s_suppkey, s_name from supplier
""")
def create_and_append(t: Tables):
    table = f"{scratch_schema(t.spark, 'appended')}.supplier"
    ensure_table(t.spark, table, "s_suppkey bigint, s_name string")
    append_table(t.supplier.select("s_name", "s_suppkey"), table)
    ensure_table(t.spark, table, "s_suppkey bigint, s_name string")
    append_table(t.supplier.select("s_suppkey", "s_name"), table)
    return t.spark.table(table)


@query("""
    select o_orderkey as id, case o_orderkey % 3 when 2 then 'c' || o_custkey else cast(o_custkey as varchar) end as code,
      case o_orderkey % 3 when 2 then cast(o_totalprice as double) else cast(o_custkey as double) end as amount,
      case o_orderkey % 3 when 2 then o_orderpriority end as note
    from orders
""")
def widened_append(t: Tables):
    """Three loads whose columns grow from whole numbers over long and decimal to text and double."""
    table = f"{scratch_schema(t.spark, 'widened')}.orders"
    loads = (
        ("int(o_custkey) as code", "int(o_custkey) as amount"),
        ("bigint(o_custkey) as code", "cast(o_custkey as decimal(12, 2)) as amount"),
        ("concat('c', o_custkey) as code", "double(o_totalprice) as amount", "o_orderpriority as note"),
    )
    for i, columns in enumerate(loads):
        append_widening(t.orders.where(F.col("o_orderkey") % 3 == i).selectExpr("o_orderkey as id", *columns), table)
    return t.spark.table(table)


def _bank_documents(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Landed document rows (owner = nation, path) and owners, both as VARIANT.

    Each file holds a bounded number of sealed customer accounts, one envelope a line.
    """
    accounts = t.customer.join(key_table(t), F.col("c_nationkey") == F.col("n_nationkey"))
    body = F.concat(
        F.lit('{"Id"=>'), "c_custkey", F.lit(', "Note"=>nil, "Name"=>"'), "c_name", F.lit('"}')
    )
    nonce = F.substring(F.unhex(F.md5(F.concat(F.lit("doc"), "c_custkey"))), 1, 12)
    data = F.aes_encrypt(body, F.col("data_key"), F.lit("GCM"), F.lit("DEFAULT"), nonce)
    url_safe = lambda c: F.translate(F.base64(c), "+/", "-_")
    envelope = F.struct(
        url_safe(F.unbase64("wrapped_key")).alias("key"),
        url_safe(F.substring(data, F.lit(13), F.octet_length(data))).alias("data"),
        url_safe(nonce).alias("nonce"),
    )
    place = scratch_path(t.spark, "documents")
    (
        accounts.select("n_nationkey", F.to_json(envelope).alias("value"))
        .write.option("maxRecordsPerFile", 1000)
        .partitionBy("n_nationkey")
        .text(place)
    )
    files = t.spark.read.format("binaryFile").load(place).select("path", "n_nationkey")
    documents = files.select(
        F.col("n_nationkey").alias("document_owner_id"),
        F.col("path").alias("cloud_file_path"),
        F.lit("bank").alias("doc_type"),
    )
    owners = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("guid"))
    return as_variant(documents), as_variant(owners)


@query("""
    select n_name as merchant_guid, c_custkey as account_id, c_name as name from customer
    join nation on c_nationkey = n_nationkey where n_regionkey <> 1
""")
def document_ingest(t: Tables):
    """Bank documents not stored yet (those of one region are), opened and flattened."""
    documents, owners = _bank_documents(t)
    stored_owners = t.nation.where("n_regionkey = 1").select(F.col("n_name").alias("merchant_guid"))
    stored = owned_documents(documents, owners, "bank").join(stored_owners, "merchant_guid", "left_semi")
    pending = pending_documents(documents, owners, stored, "bank")
    fetched = fetch_documents(pending, "file_path")
    lines = fetched.withColumn("body", F.explode(F.split(F.col("body").cast("string"), "\n"))).where("body <> ''")
    opened = open_documents(lines, key_table(t).select("wrapped_key", "data_key"))
    return stored_bank_documents(opened).select(
        "merchant_guid",
        path("raw_response", "Id", "bigint").alias("account_id"),
        path("raw_response", "Name").alias("name"),
    )


@query("""
    select doc_id, md5(text) as body_md5, n_chars, '2024-02-01' as batch_import_timestamp from documents
    where lang in ('en', 'fr') and doc_id not in (select doc_id from labels)
""")
def report_ingest(t: Tables):
    """Reports of two kinds that are not stored yet, as response rows."""
    landed = as_variant(
        t.documents.select(F.col("doc_id").cast("string").alias("lookup_key"), F.col("lang").alias("report_type"))
    )
    stored = t.labels.select(F.col("doc_id").cast("string").alias("lookup_key"))
    pending = pending_reports(landed, stored, ("en", "fr"))
    bodies = t.documents.select(
        F.col("doc_id").cast("string").alias("lookup_key"),
        "text",
        F.lit(None).cast("timestamp").alias("last_modified_at"),
    )
    rows = stored_reports(bodies.join(pending, "lookup_key", "left_semi"), F.lit("2024-02-01"))
    return rows.select(
        F.col("lookup_key").cast("bigint").alias("doc_id"),
        F.md5("raw_response").alias("body_md5"),
        F.length("raw_response").cast("bigint").alias("n_chars"),
        "batch_import_timestamp",
    )


_EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _inbox(t: Tables) -> str:
    """Events landed as several files, one folder level down per type."""
    place = scratch_path(t.spark, "inbox")
    t.events.write.partitionBy("event_type").parquet(place)
    return place


@query("select event_id, user_id, event_type from events")
def available_now_ingest(t: Tables):
    target, place = scratch_path(t.spark, "ingested"), _inbox(t)
    stream = arriving_files(t.spark, place, _EVENTS_SCHEMA, files_per_batch=3)
    checkpoint = scratch_path(t.spark, "checkpoint")
    # The second run finds nothing new.
    for _ in range(2):
        run_available(stream, checkpoint, replay_safe_files(target))
    return t.spark.read.parquet(target).select("event_id", "user_id", "event_type")


@query("select distinct user_id, event_type from events")
def new_key_ingest(t: Tables):
    target, place = scratch_path(t.spark, "keys"), _inbox(t)
    keys = ["user_id", "event_type"]
    stream = arriving_files(t.spark, place, _EVENTS_SCHEMA, files_per_batch=2).select(*keys)
    write = append_new_keys(target, keys, "user_id bigint, event_type string")
    run_available(stream, scratch_path(t.spark, "checkpoint"), write)
    return t.spark.read.parquet(target).select(*keys)


@query("""
    select user_id, event_id, event_type from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
""")
def latest_by_stream(t: Tables):
    table = f"{scratch_schema(t.spark, 'stream')}.latest"
    stream = arriving_files(t.spark, _inbox(t), _EVENTS_SCHEMA, files_per_batch=3)
    run_available(stream, scratch_path(t.spark, "checkpoint"), merge_latest(table, ["user_id"], ["ts", "event_id"]))
    return t.spark.table(table).select("user_id", "event_id", "event_type")


@query("""
    select user_id, event_id, event_type from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
""")
def latest_by_stream_in_buckets(t: Tables):
    table = scratch_path(t.spark, "latest")
    stream = arriving_files(t.spark, _inbox(t), _EVENTS_SCHEMA, files_per_batch=3)
    write = merge_latest_files(table, ["user_id"], ["ts", "event_id"], buckets=8)
    run_available(stream, scratch_path(t.spark, "checkpoint"), write)
    return t.spark.read.parquet(table).select("user_id", "event_id", "event_type")


@query("""
    select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as events,
      cast(sum(cast(value as decimal(18,2))) as double) as total
    from events group by date_trunc('day', ts), event_type
    having date_trunc('day', ts) + interval 1 day <= (select max(ts) - interval 1 hour from events)
""")
def tumbling_totals(t: Tables):
    """Totals of the days that are over; a file with rows of these days arrives too late and changes nothing."""
    target, place, checkpoint = scratch_path(t.spark, "totals"), _inbox(t), scratch_path(t.spark, "checkpoint")
    stream = arriving_files(t.spark, place, _EVENTS_SCHEMA).select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(18,2)").alias("value")
    )
    totals = totals_of(stream, "ts", ["event_type"], "value")
    run_available(totals, checkpoint, replay_safe_files(target))
    first_days = t.events.where(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz"))
    first_days.write.mode("append").partitionBy("event_type").parquet(place)
    run_available(totals, checkpoint, replay_safe_files(target))
    return t.spark.read.parquet(target).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "events",
        F.col("total").cast("double").alias("total"),
    )


@query("""
    select o_orderkey // 5000 as batch, o_orderkey % 3 as part, o_orderkey, o_totalprice from orders
    where (o_orderkey // 5000) % 4 <> 3
""")
def complete_set_ingest(t: Tables):
    """Sets of three files each that arrive over two runs; every fourth set never gets its last file."""
    inbox, data, late, checkpoint = (scratch_path(t.spark, n) for n in ("sets", "complete", "overdue", "checkpoint"))
    orders = t.orders.select(
        F.floor(F.col("o_orderkey") / 5000).alias("batch"), (F.col("o_orderkey") % 3).alias("part"), "o_orderkey", "o_totalprice"
    )
    first = (F.col("part") != 1) | (F.col("batch") % 4 == 0)

    def read(spark, paths):
        found = F.col("_metadata.file_path")
        rows = spark.read.schema("o_orderkey long, o_totalprice double").parquet(*paths)
        cells = [F.regexp_extract(found, f"{n}=(\\d+)/", 1).cast("long").alias(n) for n in ("batch", "part")]
        return rows.select(*cells, "o_orderkey", "o_totalprice", F.regexp_extract(found, "batch=(\\d+)/", 1).alias("set"))

    for run in (first, ~first & (F.col("batch") % 4 != 3)):
        landed = orders.where(run).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
        landed.repartition("batch", "part").write.mode("append").partitionBy("batch", "part").parquet(inbox)
        names = arriving_names(t.spark, inbox, "batch=(\\d+)/part=(\\d+)/")
        run_available(ended_sets(names, ["0", "1", "2"], dt.timedelta(days=7)), checkpoint, load_sets(read, data, late))
    return t.spark.read.parquet(data).drop("set")
