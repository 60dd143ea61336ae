"""Incremental loads, merges and typed landing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.dates import pivot_date, previous_month_label, utc_text
from millrace.functions.semi import as_variant, path, row_hash, typed_paths
from millrace.operators.incremental import (
    already_stored,
    high_watermark,
    in_interval,
    newer_than,
    not_in,
    not_yet_loaded,
    on_day,
)
from millrace.operators.pivots import pivot_attributes
from millrace.operators.ranges import with_row_id
from millrace.operators.typed import parse_spec, typed_select
from millrace.operators.upsert import (
    BUCKET,
    delete_insert,
    delete_insert_partitions,
    merge_latest_buckets,
    with_bucket,
    history_from_versions,
    keep_latest as latest_rows,
    snapshot,
    union_all,
)
from millrace.queries.support import Entity, Tables, query
from millrace.session import scratch_path
from millrace.sinks.tables import write_partitions
from millrace.sources.extract import usable_fields, watermark_column

ORDER_VERSIONS = Entity(
    "orders",
    (
        "o_custkey as id",
        "o_orderdate as updated_at",
        "o_orderkey as version",
        "o_orderstatus as status",
        "o_totalprice as price",
    ),
)
_DAY = "cast(cast({} as date) as string)"


@query(f"""
    select id, version, status, price, {_DAY.format('updated_at')} as updated_on
    from {ORDER_VERSIONS.sql}
    qualify row_number() over (partition by id order by updated_at desc, version desc) = 1
""")
def keep_latest(t: Tables):
    latest = latest_rows(ORDER_VERSIONS.frame(t), ["id"], ["updated_at", "version"])
    return latest.selectExpr("id", "version", "status", "price", f"{_DAY.format('updated_at')} as updated_on")


_HASHED = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_HASH_SQL = (
    "sha256(cast(to_json({c_custkey: c_custkey, c_name: c_name, "
    "c_nationkey: c_nationkey, c_mktsegment: c_mktsegment}) as varchar))"
)


@query(f"""
    with hashed as (select c_custkey, c_acctbal, {_HASH_SQL} as row_hash from customer)
    select c_custkey, row_hash from hashed
    where row_hash not in (select row_hash from hashed where c_acctbal >= 1000)
""")
def unknown_hash_incremental(t: Tables):
    hashed = t.customer.select("c_custkey", "c_acctbal", row_hash(_HASHED).alias("row_hash"))
    known = hashed.where("c_acctbal >= 1000")
    return not_in(hashed, known, "row_hash").select("c_custkey", "row_hash")


@query(f"""
    with v as (select *, sha256(cast(to_json({{id: id, version: version, status: status}}) as varchar)) as row_hash
               from {ORDER_VERSIONS.sql}),
    existing as (select * from v where updated_at < timestamp '1999-01-01'
                 qualify row_number() over (partition by id order by updated_at desc, row_hash desc) = 1),
    merged as (select * from existing union all
               select * from v where row_hash not in (select row_hash from existing))
    select id, version, status, row_hash from merged
    qualify row_number() over (partition by id order by updated_at desc, row_hash desc) = 1
""")
def change_hash_merge(t: Tables):
    rows = ORDER_VERSIONS.frame(t).withColumn("row_hash", row_hash(["id", "version", "status"]))
    by = ["updated_at", "row_hash"]
    existing = latest_rows(rows.where("updated_at < timestamp_ntz '1999-01-01'"), ["id"], by)
    unknown = not_in(latest_rows(rows, ["id"], by), existing, "row_hash")
    merged = latest_rows(union_all(unknown, existing), ["id"], by)
    return merged.select("id", "version", "status", "row_hash")


@query("""
    with files as (select o_custkey as owner, l_partkey as file, l_orderkey, l_returnflag
                   from lineitem join orders on l_orderkey = o_orderkey)
    select owner, file, l_orderkey from files f
    where not exists (select 1 from files s where s.l_returnflag = 'R' and s.owner = f.owner and s.file = f.file)
""")
def composite_anti_join(t: Tables):
    owners = t.orders.select("o_orderkey", F.col("o_custkey").alias("owner"))
    lines = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("file"), "l_returnflag")
    files = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    stored = files.where("l_returnflag = 'R'")
    return not_yet_loaded(files, stored, ["owner", "file"]).select("owner", "file", "l_orderkey")


@query("""
    select event_id, user_id from events
    where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')
""")
def id_semi_join(t: Tables):
    stored = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return already_stored(t.events.select("event_id", "user_id"), stored, "user_id")


@query("""
    select event_id, user_id, cast(ts as varchar) as ts from events
    where ts > (select max(ts) from events where ts < timestamp '2024-01-15')
""")
def high_watermark_increment(t: Tables):
    target = t.events.where("ts < timestamp_ntz '2024-01-15'")
    fresh = newer_than(t.events, "ts", high_watermark(target, "ts"))
    return fresh.select("event_id", "user_id", F.col("ts").cast("string").alias("ts"))


# An error event has no user, so its key is null and matches nothing.
_REPORT = (
    "case when event_type <> 'error' then user_id end as user_id",
    "event_type",
    "cast(cast(ts as date) as string) as day",
    "event_id",
    "value",
)
REPORT_TARGET = Entity("events", _REPORT, "ts < timestamp '2024-01-20'")
REPORT_STAGE = Entity("events", _REPORT, "ts >= timestamp '2024-01-10'")
_REPORT_KEYS = ["user_id", "event_type", "day"]
_UPSERT_SQL = f"""
    select user_id, event_type, day, event_id, value from {REPORT_TARGET.sql} t
    where not exists (select 1 from {REPORT_STAGE.sql} s
      where s.user_id = t.user_id and s.event_type = t.event_type and s.day = t.day)
    union all select user_id, event_type, day, event_id, value from {REPORT_STAGE.sql}
"""


@query(_UPSERT_SQL)
def delete_insert_upsert(t: Tables):
    return delete_insert(REPORT_TARGET.frame(t), REPORT_STAGE.frame(t), _REPORT_KEYS)


@query(_UPSERT_SQL)
def partitioned_upsert(t: Tables):
    table = scratch_path(t.spark, "report")
    REPORT_TARGET.frame(t).write.partitionBy("day").parquet(table)
    stage = REPORT_STAGE.frame(t)
    delete_insert_partitions(t.spark, table, stage, _REPORT_KEYS, "day")
    return t.spark.read.schema(stage.schema).parquet(table).select(*stage.columns)


@query(f"""
    select id, version, status, price, {_DAY.format('updated_at')} as updated_on
    from {ORDER_VERSIONS.sql}
    qualify row_number() over (partition by id order by updated_at desc, version desc) = 1
""")
def bucketed_merge(t: Tables):
    """Old versions are stored in buckets; the versions of a later period are merged in."""
    table, by = scratch_path(t.spark, "latest"), ["updated_at", "version"]
    rows = ORDER_VERSIONS.frame(t)
    old = latest_rows(rows.where("updated_at < timestamp_ntz '1999-01-01'"), ["id"], by)
    write_partitions(with_bucket(old, ["id"], 8), table, BUCKET)
    fresh = rows.where("updated_at >= timestamp_ntz '1998-06-01'")
    merge_latest_buckets(t.spark, table, fresh, ["id"], by, 8)
    stored = t.spark.read.schema(rows.schema).parquet(table)
    return stored.selectExpr("id", "version", "status", "price", f"{_DAY.format('updated_at')} as updated_on")


ORDER_TEXT = Entity(
    "orders",
    (
        "cast(o_orderkey as string) as `ORDER NBR`",
        "o_orderpriority as `Priority Desc`",
        "case when o_orderstatus = 'P' then '' when o_orderstatus = 'F' then 'n/a' "
        "else cast(cast(o_totalprice as decimal(18,2)) as string) end as `Amount #`",
        "case when o_orderstatus = 'P' then 'unknown' else cast(cast(o_orderdate as date) as string) end as `Open Date`",
        "concat(cast(cast(o_orderdate as date) as string), ' 10:11:12.345') as import_ts",
    ),
)
ORDER_SPEC = parse_spec(
    """
    order_nbr | ORDER NBR     | number(38,0)
    priority  | Priority Desc | varchar(6)
    amount    | Amount #      | number(18,2)?
    opened    | Open Date     | date
    unused    |               | null
    loaded_at | import_ts     | timestamp
    """
)


@query(f"""
    select cast(try_cast("ORDER NBR" as decimal(38,0)) as bigint) as order_nbr, left("Priority Desc", 6) as priority,
      cast(try_cast(nullif("Amount #", '') as decimal(18,2)) as double) as amount,
      cast(try_cast("Open Date" as date) as varchar) as opened, cast(null as varchar) as unused,
      strftime(cast(import_ts as timestamp), '%Y-%m-%d %H:%M:%S') as loaded_at
    from {ORDER_TEXT.sql.replace('`', '"')}
""")
def typed_load(t: Tables):
    landed = as_variant(ORDER_TEXT.frame(t))
    typed = typed_select(landed, ORDER_SPEC, read=lambda name: path("fields", name))
    return typed.select(
        F.col("order_nbr").cast("bigint").alias("order_nbr"),
        "priority",
        F.col("amount").cast("double").alias("amount"),
        F.col("opened").cast("string").alias("opened"),
        "unused",
        F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
    )


@query("""
    select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
      json_extract_string(props, '$.missing') as missing from events
""")
def path_extract(t: Tables):
    parsed = t.events.select("event_id", F.parse_json("props").alias("v"))
    return parsed.select("event_id", path("v", "k", "int").alias("k"), path("v", "missing").alias("missing"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def variant_landing(t: Tables):
    place = scratch_path(t.spark, "landed")
    as_variant(t.customer).write.option("compression", "gzip").parquet(place)
    return typed_paths(
        t.spark.read.parquet(place),
        {
            "c_custkey": "bigint",
            "c_name": "string",
            "c_nationkey": "int",
            "c_acctbal": "double",
            "c_mktsegment": "string",
        },
    )


@query("select event_id, event_type from events where cast(ts as date) = date '2024-01-12'")
def day_scan(t: Tables):
    return t.events.where(on_day(F.col("ts"), dt.date(2024, 1, 12))).select("event_id", "event_type")


@query("""
    select cast(cast(ts as date) as varchar) as day, count(*) as entries from events
    where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-17' group by 1
""")
def interval_catch_up(t: Tables):
    rows = t.events.where(in_interval(F.col("ts"), dt.date(2024, 1, 3), dt.date(2024, 1, 17)))
    day = F.to_date("ts").cast("string")
    return rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("entries"))


@query("""
    select c_custkey, c_name, c_mktsegment from customer
    where c_mktsegment in ('BUILDING', 'MACHINERY') and c_acctbal >= 0
      and c_name not in ('Customer#000000005')
""")
def key_filter_prune(t: Tables):
    kept = usable_fields("Lead", [(n, "address" if n == "c_nationkey" else ty) for n, ty in t.customer.dtypes])
    rows = t.customer.select(*kept).where(F.col("c_mktsegment").isin(["BUILDING", "MACHINERY"]))
    for condition in {"Account": ["c_acctbal >= 0"]}["Account"]:
        rows = rows.where(condition)
    rows = rows.where(~F.col("c_name").isin(["Customer#000000005"]))
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query("""
    select user_id, max(case when event_type = 'view' then value end) as sin,
      max(case when event_type = 'click' then value end) as suffix,
      max(case when event_type = 'purchase' then value end) as file_number
    from events group by user_id
""")
def attribute_pivot(t: Tables):
    names = {"view": "sin", "click": "suffix", "purchase": "file_number"}
    return pivot_attributes(t.events, "user_id", "event_type", "value", names)


@query("""
    select c_custkey, c_name from customer where c_acctbal < 0
    union
    select c_custkey, c_name from customer where c_name in ('Customer#000000001')
""")
def manual_union(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    eligible = rows.where("c_acctbal < 0").select("c_custkey", "c_name")
    listed = rows.where(F.col("c_name").isin(["Customer#000000001"])).select("c_custkey", "c_name")
    return eligible.union(listed).distinct()


@query("""
    select o_orderkey,
      case when o_orderstatus = 'P' then null else
        cast(try_strptime(concat(case when strftime(o_orderdate, '%y') < '98' then '20'
          when strftime(o_orderdate, '%y') = '98' and month(o_orderdate) <= 6 then '20' else '19' end,
          strftime(o_orderdate, '%y%m%d')), '%Y%m%d') as date)::varchar end as d
    from orders
""")
def pivot_two_digit_years(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MM-dd")).otherwise(
        F.date_format("o_orderdate", "MMddyy")
    )
    return t.orders.select(
        "o_orderkey", pivot_date(text, dt.date(2098, 6, 30)).cast("string").alias("d")
    )


@query("""
    select o_orderkey, strftime(date_trunc('month', o_orderdate) - interval 1 day, '%Y%m') as import_month,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') as stamp
    from orders
""")
def previous_month(t: Tables):
    return t.orders.select(
        "o_orderkey",
        previous_month_label(F.to_date("o_orderdate")).alias("import_month"),
        utc_text(F.col("o_orderdate")).alias("stamp"),
    )


@query("select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey) as id, * from "
       "(select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem)")
def global_row_id(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    return with_row_id(rows, rows.columns)


_VALID = f"{_DAY.format('valid_from')} as valid_from, {_DAY.format('valid_to')} as valid_to"


@query(f"""
    select id, version, status, {_VALID} from (
      select id, version, status, updated_at as valid_from,
        lead(updated_at) over (partition by id order by updated_at, version) as valid_to
      from {ORDER_VERSIONS.sql})
""")
def version_history(t: Tables):
    versions = ORDER_VERSIONS.frame(t).select("id", "version", "status", "updated_at")
    history = history_from_versions(versions, ["id"], ["updated_at", "version"])
    return history.selectExpr("id", "version", "status", *_VALID.split(", "))


@query(f"""
    with before as (select * from {ORDER_VERSIONS.sql} where updated_at < timestamp '1998-06-01'
        qualify row_number() over (partition by id order by updated_at desc, version desc) = 1),
    now as (select * from {ORDER_VERSIONS.sql}
        qualify row_number() over (partition by id order by updated_at desc, version desc) = 1),
    merged as (
      select b.id, b.status, b.updated_at as valid_from,
        case when n.updated_at > b.updated_at then n.updated_at end as valid_to
      from before b left join now n on b.id = n.id
      union all
      select n.id, n.status, n.updated_at, null from now n left join before b on b.id = n.id
      where b.id is null or n.updated_at > b.updated_at)
    select id, status, {_VALID} from merged
""")
def snapshot_merge(t: Tables):
    rows, by = ORDER_VERSIONS.frame(t), ["updated_at", "version"]
    before = latest_rows(rows.where("updated_at < timestamp_ntz '1998-06-01'"), ["id"], by)
    now = latest_rows(rows, ["id"], by)
    history = before.withColumn("valid_from", F.col("updated_at")).withColumn(
        "valid_to", F.lit(None).cast("timestamp_ntz")
    )
    return snapshot(history, now, "id", "updated_at").selectExpr("id", "status", *_VALID.split(", "))


@query("""
    select name, case
      when name = 'customer' then 'SystemModstamp' when name = 'LeadHistory' then 'CreatedDate'
      when name = 'LeadShare' then 'LastModifiedDate' else 'LastModifiedDate' end as watermark,
      n as rows_to_load
    from (select 'customer' as name, (select count(*) from customer) as n
      union all select 'LeadHistory', (select count(*) from orders)
      union all select 'LeadShare', (select count(*) from lineitem)
      union all select 'Task', (select count(*) from events))
""")
def extract_watermarks(t: Tables):
    stamped = ["Id", "SystemModstamp", "LastModifiedDate", "CreatedDate"]
    objects = {
        "customer": (t.customer, stamped),
        "LeadHistory": (t.orders, stamped),
        "LeadShare": (t.lineitem, stamped),
        "Task": (t.events, ["Id", "LastModifiedDate", "CreatedDate"]),
    }
    return union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("rows_to_load")).select(
                F.lit(name).alias("name"),
                F.lit(watermark_column(name, fields)).alias("watermark"),
                "rows_to_load",
            )
            for name, (df, fields) in objects.items()
        ]
    )
