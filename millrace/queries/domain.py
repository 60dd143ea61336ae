"""Reports, calls, journal entries, cash flow, balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semi import path
from millrace.functions.stats import t_quantile
from millrace.operators.incremental import not_in
from millrace.operators.ranges import in_order, running_total_before
from millrace.plans.calls import CALL_TABLE, entries_of, new_calls
from millrace.plans.cashflow import (
    closing_balances,
    daily_series,
    guardrail as guardrail_of,
    opening_balances,
    period_balances,
)
from millrace.plans.journal import journal_entries as entries_for
from millrace.plans.journal import journal_lines as lines_of
from millrace.plans.journal import tally
from millrace.plans.reports import load_report, load_report_files
from millrace.queries.support import CHECKS, Entity, Tables, query
from millrace.session import scratch_path, scratch_schema
from millrace.sinks.filetable import merge_files, read_files_table
from millrace.sinks.tables import append_table, ensure_table
from millrace.sources.calls import RECORDINGS_SCHEMA, day_slices, explode_recordings, report_entries
from millrace.sources.files import read_json
from millrace.sources.reports import NAME_PREFIX, PAGE_SCHEMA, Report, flatten_report, next_page_token

_ROWS_PER_PAGE = 100


def _header(*dimensions: str):
    name = lambda n: F.lit(NAME_PREFIX + n)
    entries = F.array(F.struct(name("sessions").alias("name")), F.struct(name("adCost").alias("name")))
    return F.struct(
        F.array(*[name(d) for d in dimensions]).alias("dimensions"),
        F.struct(entries.alias("metricHeaderEntries")).alias("metricHeader"),
    )


def _pages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Events as landed report pages of a hundred rows, by their place in the file."""
    events = t.events if events is None else events
    row = F.struct(
        F.array(F.date_format("ts", "yyyyMMdd"), F.col("user_id").cast("string"), "event_type").alias("dimensions"),
        F.array(
            F.struct(F.array(F.lit("0"), F.lit("0")).alias("values")),
            F.struct(F.array(F.col("event_id").cast("string"), F.col("value").cast("string")).alias("values")),
        ).alias("metrics"),
    )
    page = F.floor(F.col("_metadata.row_index") / _ROWS_PER_PAGE)
    placed = events.select(F.col("_metadata.file_name").alias("file"), page.alias("page"), row.alias("row"))
    packed = placed.groupBy("file", "page").agg(F.collect_list("row").alias("rows"))
    report = F.struct(
        _header("date", "dimension6", "eventAction").alias("columnHeader"),
        F.struct("rows").alias("data"),
        F.lit(None).cast("string").alias("nextPageToken"),
    )
    place = scratch_path(t.spark, "pages")
    packed.select(F.array(report).alias("reports")).write.json(place)
    return read_json(t.spark, place, PAGE_SCHEMA)


@query("""
    select strftime(ts, '%Y%m%d') as date, '2024-02-01 00:00:00.000' as import_ts,
      cast(user_id as varchar) as dimension6, event_type as "eventAction",
      cast(event_id as varchar) as sessions, cast(value as varchar) as "adCost"
    from events
""")
def report_flatten(t: Tables):
    columns = ["dimension6", "eventAction", "sessions", "adCost"]
    return flatten_report(_pages(t), columns, "2024-01-31", "2024-02-01 00:00:00.000")


@query("""
    with stage as (select * from events where ts >= timestamp '2024-01-10')
    select strftime(ts, '%Y%m%d') as date, import_ts, cast(user_id as varchar) as dimension6,
      event_type as "eventAction", cast(event_id as varchar) as sessions from (
        select *, 'first' as import_ts from events e where ts < timestamp '2024-01-20' and not exists (
          select 1 from stage s where s.user_id = e.user_id and s.event_type = e.event_type
            and cast(s.ts as date) = cast(e.ts as date))
        union all select *, 'second' from stage)
""")
def report_upsert(t: Tables):
    """Two overlapping runs of a report; the second replaces records with equal keys."""
    report = Report(("dimension6", "eventAction"), ("sessions",), ("dimension6", "eventAction", "date"))
    table = f"{scratch_schema(t.spark, 'reports')}.events"
    early = t.events.where("ts < timestamp_ntz '2024-01-20'")
    late = t.events.where("ts >= timestamp_ntz '2024-01-10'")
    load_report(_pages(t, early), report, table, "2024-01-20", "first")
    load_report(_pages(t, late), report, table, "2024-01-31", "second")
    return t.spark.table(table)


@query(CHECKS["report_upsert"])
def report_upsert_by_files(t: Tables):
    """The same two runs into a table of files; the second run leaves files alone that hold none of its keys."""
    report = Report(("dimension6", "eventAction"), ("sessions",), ("dimension6", "eventAction", "date"))
    place = scratch_path(t.spark, "report-files")
    early = t.events.where("ts < timestamp_ntz '2024-01-20'")
    late = t.events.where("ts >= timestamp_ntz '2024-01-10'")
    load_report_files(_pages(t, early), report, place, "2024-01-20", "first")
    load_report_files(_pages(t, late), report, place, "2024-01-31", "second")
    return read_files_table(t.spark, place)


@query("""
    select o_orderkey, o_custkey, case when o_orderkey % 40 = 0 and o_orderkey <= (select max(o_orderkey) // 4 from orders)
        then 'changed' else o_orderpriority end as label from orders
    union all
    select -o_orderkey, o_custkey, 'added' from orders where o_orderkey % 40 = 2
""")
def merge_by_files(t: Tables):
    """Orders in a table of files: a first load, changes in the lowest quarter of the keys, then new keys."""
    place = scratch_path(t.spark, "order-files")
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    changed = orders.where(f"o_orderkey % 40 = 0 and o_orderkey <= {top // 4}").withColumn("label", F.lit("changed"))
    added = orders.where("o_orderkey % 40 = 2").withColumn("o_orderkey", -F.col("o_orderkey")).withColumn("label", F.lit("added"))
    for stage in (orders, changed, added):
        merge_files(stage, place, ["o_orderkey"])
    return read_files_table(t.spark, place)


@query("select cast(event_id + 1 as varchar) as next_page_token from events where event_type <> 'view'")
def report_page_tokens(t: Tables):
    report = F.struct(
        _header("date").alias("columnHeader"),
        F.when(F.col("event_type") != "view", (F.col("event_id") + 1).cast("string")).alias("nextPageToken"),
    )
    return next_page_token(t.events.select(F.array(report).alias("reports")))


@query("""
    with turns as (select 'c' || conv_id || '-' || turn as call_id, role, md5(text) as id from conversations)
    select call_id, id as recording_id, 'media/' || id as media_link from turns where role <> 'system'
    union all select call_id, id || 'b', 'media/' || id || 'b' from turns where role = 'assistant'
    union all select call_id, null, null from turns where role = 'system'
""")
def call_recordings(t: Tables):
    """Turns as calls: the assistant's have two recordings, the user's one, the system's none."""

    def recording(suffix: str):
        key = F.concat(F.md5("text"), F.lit(suffix))
        media = F.struct(F.struct(F.concat(F.lit("media/"), key).alias("href")).alias("media"))
        return F.struct(key.alias("id"), media.alias("_links"))

    second = F.when(F.col("role") == "assistant", recording("b"))
    nested = F.struct(F.struct(F.array_compact(F.array(recording(""), second)).alias("recordings")).alias("_embedded"))
    call = F.struct(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("call_id"))
    landed = t.conversations.select(
        call.alias("call"), F.when(F.col("role") != "system", nested).alias("recordings")
    )
    place = scratch_path(t.spark, "calls")
    landed.write.json(place)
    return explode_recordings(
        read_json(t.spark, place, f"call struct<call_id: string>, recordings {RECORDINGS_SCHEMA.strip()}")
    )


@query("""
    select call_id, role, recording from (
      select 'c' || conv_id || '-' || turn as call_id, role, case when role <> 'system' then md5(text) end as recording
      from conversations)
""")
def call_ingest(t: Tables):
    """Two overlapping runs of day reports into a table with two VARIANT columns."""
    table = f"{scratch_schema(t.spark, 'calls')}.calls"
    ensure_table(t.spark, table, CALL_TABLE)
    call_id = F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn")
    entry = F.struct(call_id.alias("call_id"), "role")
    turns = t.conversations.withColumns(
        {
            "call_id": call_id,
            "report": F.to_json(F.struct(F.array(entry).alias("entries"))),
            "body": F.to_json(F.struct(F.md5("text").alias("id"))),
        }
    )
    recordings = turns.where("role <> 'system'").select("call_id", "body")
    for reports in (turns.where("role <> 'assistant'"), turns):
        entries = entries_of(reports, "report")
        append_table(new_calls(entries, t.spark.table(table), recordings), table)
    return t.spark.table(table).select(
        path("call", "call_id").alias("call_id"),
        path("call", "role").alias("role"),
        path("recordings", "id").alias("recording"),
    )


@query("""
    select strftime(d.day, '%Y-%m-%d') as day, 2 * count(e.event_id) as new_calls
    from (select unnest(generate_series(date '2023-12-30', date '2024-01-20', interval 1 day)) as day) d
    left join (select * from events where event_id not in (select event_id from events where event_type = 'view')) e
      on cast(e.ts as date) = cast(d.day as date)
    group by 1
""")
def call_report_days(t: Tables):
    """New calls per day of a catch-up interval, from reports that hold arrays of entries."""

    def entry(side: str):
        key = F.concat(F.col("event_id").cast("string"), F.lit(side))
        return F.struct(key.alias("call_id"), F.col("ts").cast("string").alias("at"))

    reports = t.events.select(F.array(entry("a"), entry("b")).alias("entries"))
    calls = report_entries(reports).select("call.call_id", F.to_timestamp("call.at").alias("at"))
    sides = F.explode(F.array(F.lit("a"), F.lit("b")))
    views = t.events.where("event_type = 'view'").select("event_id", sides.alias("side"))
    stored = views.select(F.concat(F.col("event_id").cast("string"), "side").alias("call_id"))
    fresh = not_in(calls, stored, "call_id")
    days = day_slices(t.spark, dt.date(2023, 12, 30), dt.date(2024, 1, 21))
    per_day = fresh.groupBy(F.date_trunc("day", "at").alias("from_ts")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "from_ts", "left").select(
        F.date_format("from_ts", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("new_calls")
    )


LEDGER = Entity(
    "lineitem",
    (
        "case when l_tax < 0.08 then l_orderkey end as correlation_guid",
        "l_shipdate as posted_at",
        "case when l_returnflag = 'A' then cast(l_extendedprice as decimal(18,2)) "
        "when l_returnflag = 'R' then cast(0 as decimal(18,2)) end as credit_amount",
        "case when l_linestatus = 'O' or l_returnflag = 'R' then cast(l_extendedprice as decimal(18,2)) end as debit_amount",
        "l_suppkey as ns_account_internal_id",
        "case when l_quantity < 49 then case when l_linestatus = 'O' then 6 else 11 end end as ns_subsidiary_id",
    ),
)
_GROUPS = f"""
    groups as (select correlation_guid, count(distinct ns_subsidiary_id) as n, min(ns_subsidiary_id) as sub,
        max(posted_at) as posted_at, count(*) as transactions
      from {LEDGER.sql} where correlation_guid is not null group by 1)
"""


@query(f"""
    with {_GROUPS}
    select correlation_guid, case when n = 1 then 'accepted' else 'rejected' end as status,
      case when n <> 1 then 'Different subsidiary' end as error, case when n = 1 then sub end as subsidiary_id,
      strftime((posted_at at time zone 'America/Toronto') at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as transaction_at,
      'Platform Transaction - 2020-01-01' as memo, transactions
    from groups
""")
def journal_entries(t: Tables):
    entries = entries_for(LEDGER.frame(t), "2020-01-01")
    return entries.withColumn("transaction_at", F.date_format("transaction_at", "yyyy-MM-dd HH:mm:ss"))


@query(f"""
    with {_GROUPS}, kept as (select l.* from {LEDGER.sql} l join groups g
        on l.correlation_guid = g.correlation_guid where n = 1)
    select correlation_guid, ns_account_internal_id as account_id, 1 as side,
      cast(credit_amount as double) as credit, cast(null as double) as debit, 'Transaction ID: ' || correlation_guid as memo
    from kept where credit_amount <> 0
    union all
    select correlation_guid, ns_account_internal_id, 2, null, cast(debit_amount as double), 'Transaction ID: ' || correlation_guid
    from kept where debit_amount <> 0
""")
def journal_lines(t: Tables):
    ledger = LEDGER.frame(t)
    lines = lines_of(ledger, entries_for(ledger, "2020-01-01"))
    return lines.withColumns({c: F.col(c).cast("double") for c in ("credit", "debit")})


@query(f"""
    with {_GROUPS}
    select case when n = 1 then 'accepted' else 'rejected' end as status, count(*) as entries from groups group by 1
""")
def journal_tally(t: Tables):
    return tally(entries_for(LEDGER.frame(t), "2020-01-01"))


# Purchases and sign-ups bring money in, every other event takes some out.
_INFLOW = "event_type in ('purchase', 'signup')"
_AMOUNT = "cast(value as decimal(18,2))"
_DAILY_SQL = f"""
    daily as (select user_id as series_id, cast(ts as date) as date,
        sum(case when {_INFLOW} then {_AMOUNT} else 0 end) as credits,
        sum(case when {_INFLOW} then 0 else {_AMOUNT} end) as debits
      from events group by 1, 2),
    opened as (select *, 1000 + coalesce(sum(credits - debits) over (partition by series_id order by date
        rows between unbounded preceding and 1 preceding), 0) as balance from daily)
"""


def _daily(t: Tables) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    inflow, amount = F.expr(_INFLOW), F.expr(_AMOUNT)
    return daily_series(
        t.events,
        "user_id",
        F.to_date("ts"),
        F.when(inflow, amount).otherwise(zero),
        F.when(inflow, zero).otherwise(amount),
    )


def _opened(t: Tables) -> DataFrame:
    return opening_balances(_daily(t), F.lit(1000))


@query(f"""
    with {_DAILY_SQL}
    select series_id, cast(date as varchar) as date, cast(balance as double) as balance from opened
""")
def opening_balance(t: Tables):
    return _opened(t).select(
        "series_id", F.col("date").cast("string").alias("date"), F.col("balance").cast("double").alias("balance")
    )


@query(f"""
    select event_id, user_id, cast(coalesce(sum(case when {_INFLOW} then {_AMOUNT} else -{_AMOUNT} end) over (
      partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as double) as balance
    from events
""")
def movement_balance(t: Tables):
    """The roll-forward per movement: a series of any length is cut into ranges."""
    signed = F.when(F.expr(_INFLOW), F.expr(_AMOUNT)).otherwise(-F.expr(_AMOUNT))
    moves = t.events.select("event_id", "user_id", "ts", signed.alias("amount"))
    ordered = in_order(moves, ["user_id"], ["ts", "event_id"])
    total = running_total_before(ordered, ["user_id"], F.col("amount"), "balance")
    return total.select("event_id", "user_id", F.col("balance").cast("double").alias("balance"))


_SPLIT_DAY = "2024-01-21"
# The inverse t distribution is not in SQL: its values by degrees of freedom.
_T_VALUES = ", ".join(f"({d}, {t_quantile(d)!r})" for d in range(1, 61))


@query(f"""
    with {_DAILY_SQL}, t(dof, t) as (values {_T_VALUES}),
    hist as (select series_id, date, cast(balance as double) as y, cast(credits as double) as c,
        cast(debits as double) as d, row_number() over (partition by series_id order by date) as x
      from opened where date < date '{_SPLIT_DAY}'),
    fit as (select series_id, count(*) as n, avg(x) as mx, regr_slope(y, x) as b, regr_intercept(y, x) as a,
        regr_sxx(y, x) as sxx, regr_syy(y, x) as syy, regr_sxy(y, x) as sxy, arg_max(y + c - d, date) as opening
      from hist group by 1),
    ahead as (select series_id, count(*) as m,
        sum(cast(credits as double) - cast(debits as double))
          - arg_max(cast(credits as double) - cast(debits as double), date) as moved
      from opened where date >= date '{_SPLIT_DAY}' group by 1),
    band as (select series_id, n, opening + moved as projected, a + b * (n + m) as e,
        t * sqrt((syy - sxy * sxy / sxx) / (n - 2) * (1 + 1.0 / n + power(n + m - mx, 2) / sxx)) as s
      from fit join ahead using (series_id) join t on t.dof = n - 2)
    select series_id, n, round(e - s, 3) as lower, round(projected, 3) as projected, round(e + s, 3) as upper,
      not (projected between e - s and e + s) as outside
    from band
""")
def guardrail(t: Tables):
    opened = _opened(t).withColumns(
        {c: F.col(c).cast("double") for c in ("credits", "debits", "balance")}
    )
    split = F.lit(_SPLIT_DAY).cast("date")
    history = opened.where(F.col("date") < split)
    projection = opened.where(F.col("date") >= split).select(
        "series_id",
        "date",
        F.col("credits").alias("credits_prediction"),
        F.col("debits").alias("debits_prediction"),
    )
    result = guardrail_of(history, projection)
    return result.withColumns({c: F.round(c, 3) for c in ("lower", "projected", "upper")})


def _period_sql(period: str) -> str:
    return f"""
    with {_DAILY_SQL},
    last as (select series_id, cast(date_trunc('{period}', date) as date) as period_start,
        arg_max(balance + credits - debits, date) as balance from opened group by 1, 2)
    select series_id, cast(period_start as varchar) as period_start, cast(balance as double) as balance,
      cast(balance - lag(balance) over (partition by series_id order by period_start) as double) as change
    from last
    """


def _periods(t: Tables, period: str) -> DataFrame:
    balances = period_balances(closing_balances(_daily(t), F.lit(1000)), period)
    return balances.select(
        "series_id",
        F.col("period_start").cast("string").alias("period_start"),
        F.col("balance").cast("double").alias("balance"),
        F.col("change").cast("double").alias("change"),
    )


@query(_period_sql("day"))
def daily_balances(t: Tables):
    return _periods(t, "day")


@query(_period_sql("week"))
def weekly_balances(t: Tables):
    return _periods(t, "week")


@query(_period_sql("month"))
def monthly_balances(t: Tables):
    return _periods(t, "month")
