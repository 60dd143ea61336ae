"""Files, clean-up, bureau requests and responses, validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import month_before
from millrace.functions.address import address_lines, clean_address, full_address, phone_text
from millrace.functions.text import (
    record_id_18,
    ruby_hash_to_json,
    to_string,
    transliterate_fr,
)
from millrace.operators.crypto import decrypt_columns
from millrace.operators.quality import table_checks as checks_of, validate_lines
from millrace.operators.typed import DETAIL_SPEC, parse_spec
from millrace.plans.bureau_request import (
    commercial_request,
    commercial_rows,
    consumer_lines,
    consumer_request,
    request_counts,
)
from millrace.plans.bureau_response import (
    ResponseTargets,
    load_commercial_responses,
    load_consumer_response,
    raw_response,
)
from millrace.queries.support import (
    ADDRESSES,
    APPLICANT_LINKS,
    APPLICANT_MERCHANTS,
    APPLICANTS,
    AS_OF,
    ATTRIBUTES,
    COMMERCIAL_MERCHANTS,
    LOANS,
    MERCHANT_LINKS,
    PHONE_LINKS,
    PHONES,
    SQL_ADDRESS_LINES,
    SQL_CLEAN_ADDRESS,
    Entity,
    Tables,
    key_table,
    query,
    sealed_columns,
    sql_clean,
    sql_transliterate,
    union_frame,
    union_sql,
)
from millrace.session import scratch_path, scratch_schema
from millrace.sinks.requests import frame_lines, write_lines
from millrace.sinks.tables import write_dated_copy
from millrace.sources.files import audited, list_files, read_csv, route_files, source_file, write_csv
from millrace.sources.fixedwidth import drop_markers, parse, read_lines, render
from millrace.sources.streams import read_csv_splits, read_json_objects
from millrace.sources.layout import REQUEST_LAYOUT, RESPONSE_HEAD

RUN_DATE = dt.date(2021, 9, 2)
STAMP = dt.datetime(2020, 11, 3, 19, 16, 9)
HEADER = "BHDR-EQUIFAX20201103191609ADVITFINSCOREDA2"
TRAILER = "BTRL-EQUIFAX20201103191609ADVITFINSCOREDA2"

PART_TEXT = Entity(
    "part",
    (
        "p_partkey",
        # Quotes, commas and line breaks inside the values.
        "concat(p_name, ' \"', p_brand, '\", ', p_type, chr(10), 'x') as p_name",
        "case when p_size > 25 then '' else p_brand end as p_brand",
        "p_size",
        "p_retailprice",
    ),
)


@query(f"select p_partkey, p_name, p_brand, p_size, p_retailprice from {PART_TEXT.sql}")
def csv_round_trip(t: Tables):
    rows, place = PART_TEXT.frame(t), scratch_path(t.spark, "csv")
    write_csv(rows, place)
    return read_csv(t.spark, place, rows.schema, newlines_in_values=True)


LINE_TEXT = Entity(
    "lineitem",
    (
        "l_orderkey",
        "l_linenumber",
        "concat(l_returnflag, ' \"', l_linestatus, '\",', chr(10), chr(10), cast(l_partkey as string)) as l_note",
        "case when l_quantity > 25 then '' else concat(chr(13), chr(10), l_returnflag) end as l_mark",
        "l_extendedprice",
    ),
)


@query(f"select * from {LINE_TEXT.sql}")
def csv_splits(t: Tables):
    """Line breaks in values; each file is read by as many tasks as it has splits."""
    rows, place = LINE_TEXT.frame(t), scratch_path(t.spark, "csv")
    write_csv(rows, place)
    return read_csv_splits(t.spark, place, rows.schema)


EVENT_TEXT = Entity(
    "events",
    (
        "event_id",
        "user_id",
        "value",
        "concat(event_type, '}{\"', chr(92), props, chr(10), '}') as note",
    ),
)


@query(f"select * from {EVENT_TEXT.sql}")
def json_objects(t: Tables):
    """Objects landed back to back, a hundred a line, with braces, quotes and line breaks in their texts."""
    rows, place = EVENT_TEXT.frame(t), scratch_path(t.spark, "objects")
    packed = rows.groupBy(F.floor(F.col("event_id") / 100).alias("line")).agg(F.collect_list(F.to_json(F.struct(*rows.columns))).alias("objects"))
    packed.select(F.array_join("objects", "")).write.text(place)
    return read_json_objects(t.spark, place, rows.schema)


@query("""
    select s_suppkey, '202108' as import_month, cast(null as varchar) as accountid,
      '2021-09-02 10:00:00.000' as import_ts, 'supplier.parquet' as imported_file_name
    from supplier
""")
def audit_columns(t: Tables):
    named = t.supplier.select("s_suppkey", source_file().alias("imported_file_name"))
    return audited(
        named,
        import_month=month_before(RUN_DATE),
        accountid=F.lit(None).cast("string"),
        import_ts="2021-09-02 10:00:00.000",
    )


# Applicants as they look after decryption, with the fields of an address.
REQUEST_ROWS = Entity(
    "customer",
    (
        "c_custkey + 1 as id",
        "concat('app_', lpad(cast(c_custkey as string), 16, '0')) as applicant_guid",
        "concat('  ', c_mktsegment, '-Élise Œuvrard de la Tour ') as last_name",
        "c_name as first_name",
        "case when c_acctbal < 0 then 'Renée' end as middle_name",
        "case when c_nationkey = 3 then 'JR' end as suffix",
        "case when c_nationkey <> 4 then lpad(cast(c_custkey as string), 9, '1') end as sin",
        "case when c_nationkey = 5 then 'unknown' else '1956-12-22' end as date_of_birth",
        "case when c_mktsegment <> 'HOUSEHOLD' then 'Montréal' end as city",
        "'CAN' as country_alpha_3",
        "case when c_nationkey < 5 then cast(c_nationkey as string) end as post_box_number",
        "case when c_nationkey < 5 then 'CP' end as post_box_type",
        "case when c_nationkey = 9 then 'H3H11H' else 'H3H1H1' end as postal_code",
        "case when c_mktsegment <> 'HOUSEHOLD' then cast(c_custkey as string) end as premise_number",
        "case when c_nationkey = 11 then 'Q3' else 'QC' end as state_province",
        "case when c_acctbal > 6000 then '12' end as sub_premise_number",
        "case when c_acctbal > 8000 then 'Étage' end as sub_premise_type",
        "case when c_mktsegment <> 'HOUSEHOLD' then 'rue de la Côte-des-Neiges' end as thoroughfare",
        "case when c_nationkey > 20 then 'RR 2' end as rural_routes",
        "case when c_nationkey > 22 then 'Site É' end as rural_additional_content",
        "cast(c_custkey * 13 as string) as file_number",
    ),
)


def _pad(c: str, n: int) -> str:
    return f"rpad(left({c}, {n}), {n}, ' ')"


_REQUEST_LINE = " || ".join(
    [
        _pad("lpad(cast(id as varchar), 12, '0')", 12),
        _pad(sql_transliterate(sql_clean("last_name")), 25),
        _pad(sql_transliterate(sql_clean("first_name")), 15),
        _pad(sql_transliterate(sql_clean("middle_name")), 10),
        _pad(sql_transliterate(sql_clean("suffix")), 2),
        "repeat(' ', 15)",
        _pad("coalesce(nullif(trim(sin), ''), '000000000')", 9),
        _pad("coalesce(strftime(try_strptime(date_of_birth, '%Y-%m-%d'), '%m%d%y'), '')", 6),
        _pad("lines", 30),
        _pad("city", 20),
        _pad("state_province", 2),
        _pad("postal_code", 6),
        _pad("file_number", 10),
        "repeat(' ', 8)",
        _pad("applicant_guid", 25),
        "repeat(' ', 25)",
    ]
)
REQUEST_SQL = f"""(
    select id, applicant_guid, {_REQUEST_LINE} as line from (
      select *, {SQL_ADDRESS_LINES} as lines from (
        select id, applicant_guid, last_name, first_name, middle_name, suffix, sin, date_of_birth, file_number,
          {SQL_CLEAN_ADDRESS} from {REQUEST_ROWS.sql})))"""


@query(f"select id, line from {REQUEST_SQL}")
def fixed_width_render(t: Tables):
    return consumer_lines(REQUEST_ROWS.frame(t))


def _request_file(t: Tables) -> str:
    place = scratch_path(t.spark, "request")
    write_lines(frame_lines(consumer_lines(REQUEST_ROWS.frame(t)), STAMP), place)
    return place


@query(f"""
    select line as value from {REQUEST_SQL}
    union all select '{HEADER}'
    union all select '{TRAILER}' || lpad(cast(count(*) as varchar), 8, '0') from customer
""")
def request_file_lines(t: Tables):
    return read_lines(t.spark, _request_file(t), "windows-1252").select("value")


_STARTS = dict(zip(REQUEST_LAYOUT.names, REQUEST_LAYOUT.starts))
_PARSED = ", ".join(
    f"trim(substr(line, {_STARTS[n] + 1}, {w})) as {n}" for n, w in REQUEST_LAYOUT.fields
)


@query(f"select {_PARSED} from {REQUEST_SQL}")
def fixed_width_parse(t: Tables):
    lines = read_lines(t.spark, _request_file(t), "windows-1252")
    return parse(drop_markers(lines), REQUEST_LAYOUT)


# Faults over the whole request file: a letter in every seventh sin, every eleventh line cut behind the birth date.
_WRONG_SIN, _SHORT = "id % 7 = 3", "id % 11 = 5"
_CUT = 94


def _faulty_file(t: Tables) -> str:
    """The request file with these faults, a wrong header and a wrong count in its trailer."""
    sin = F.concat(F.substring("line", 1, 79), F.lit("12345678X"), F.expr("substring(line, 89)"))
    body = consumer_lines(REQUEST_ROWS.frame(t)).withColumn("line", F.when(F.expr(_WRONG_SIN), sin).otherwise(F.col("line")))
    body = body.withColumn("line", F.when(F.expr(_SHORT), F.substring("line", 1, _CUT)).otherwise(F.col("line")))
    edge, count = F.col("line"), F.expr("cast(cast(substring(line, 43) as bigint) + 1 as string)")
    line = F.when(edge.startswith("BHDR-"), F.concat(F.lit("X"), F.expr("substring(line, 2)")))
    line = line.when(edge.startswith("BTRL-"), F.concat(F.substring("line", 1, 42), F.lpad(count, 8, "0"))).otherwise(edge)
    place = scratch_path(t.spark, "faulty")
    write_lines(frame_lines(body, STAMP).withColumn("line", line), place)
    return place


@query(f"""
    with r as (select id, applicant_guid, case when {_WRONG_SIN} then substr(line, 1, 79) || '12345678X' || substr(line, 89)
        else line end as line from {REQUEST_SQL}),
    f as (select case when {_SHORT} then '' else applicant_guid end as guid,
        case when {_SHORT} then substr(line, 1, {_CUT}) else line end as line from r),
    l as (select guid, line, length(line) + 1 as len,
        substr(line, 89, 6) as dob, substr(line, 95, 30) as address, substr(line, 125, 20) as city,
        substr(line, 145, 2) as province, substr(line, 147, 6) as postal, substr(line, 80, 9) as sin
      from f)
    select category, guid, value from (
      select 'dob' as category, guid, dob as value from l where not regexp_full_match(dob, '[0-9]{{6}}')
        or not (cast(substr(dob, 1, 2) as int) between 1 and 12 and cast(substr(dob, 3, 2) as int) between 1 and 31)
      union all select 'address', guid, address from l where trim(address) = '' and address <> ''
      union all select 'city', guid, city from l where trim(city) = '' and city <> ''
      union all select 'province', guid, province from l where not regexp_full_match(province, '[A-Za-z]+') and province <> ''
      union all select 'postal', guid, postal from l
        where not regexp_matches(postal, '^[a-zA-Z][0-9][a-zA-Z][0-9][a-zA-Z][0-9]') and postal not in ('      ', '')
      union all select 'sin', guid, sin from l where not regexp_full_match(sin, '[0-9]+') and sin <> '         '
      union all select 'length', null, cast(len as varchar) from l where len <> 221
      union all select 'header', null, 'prefix error: X{HEADER[1:]}' || chr(10)
      union all select 'footer', null, 'count error: ' || cast(count(*) + 1 as varchar) from l)
""")
def line_validation(t: Tables):
    return validate_lines(read_lines(t.spark, _faulty_file(t), "windows-1252"))


RESPONSE_ROWS = Entity(
    "customer",
    (
        "lpad(cast(c_custkey as string), 12, '0') as customer_reference_number",
        "'Tremblay' as last_name",
        "c_name as first_name",
        "'' as middle_name",
        "'JR' as suffix",
        "'x, y' as filler_1",
        "'999999999' as sin",
        "'122256' as dob_text",
        "c_mktsegment as address",
        "'Montréal' as city",
        "'QC' as province",
        "'H3H1H1' as postal_code",
        # Dates of both centuries, a blank, an impossible day and text with a dash.
        "case c_mktsegment when 'BUILDING' then '053020' when 'MACHINERY' then '123199' "
        "when 'HOUSEHOLD' then '' when 'FURNITURE' then '023021' else '05-30-20' end as unique_number",
        "cast(c_nationkey as string) as filler_2",
        "concat('app_', lpad(cast(c_custkey as string), 16, '0')) as applicant_guid",
    ),
)


def _response_file(t: Tables) -> str:
    """A landed response file in Latin-1, with its marker lines."""
    rows = RESPONSE_ROWS.frame(t)
    values = {n: F.col(n) for n in rows.columns}
    body = rows.select(
        F.col("customer_reference_number").cast("long").alias("id"),
        render(RESPONSE_HEAD, values).alias("line"),
    )
    place = scratch_path(t.spark, "response")
    write_lines(frame_lines(body, STAMP), place, "ISO-8859-1")
    return place


_MASKED = ("last_name", "first_name", "middle_name", "sin", "dob_text", "address", "city", "province", "postal_code")


@query(f"""
    select customer_reference_number, suffix, filler_1, unique_number, filler_2, applicant_guid, '' as filler_3,
      {', '.join(f"'' as {c}" for c in _MASKED)}
    from {RESPONSE_ROWS.sql}
""")
def mask_ranges(t: Tables):
    return raw_response(read_lines(t.spark, _response_file(t)), RESPONSE_HEAD)


@query(f"""
    select '202108' as import_month, cast(null as varchar) as accountid, '2021-09-02 00:00:00.000' as import_ts,
      customer_reference_number, '' as last_name, suffix, applicant_guid,
      case unique_number when '053020' then '2020-05-30' when '123199' then '1999-12-31' end as unique_number,
      (select count(*) from customer) as dated_rows
    from {RESPONSE_ROWS.sql}
""")
def response_chain(t: Tables):
    schema = scratch_schema(t.spark, "bureau")
    targets = ResponseTargets(
        raw=f"{schema}.raw",
        raw_history=scratch_path(t.spark, "raw_history"),
        staged=f"{schema}.staged",
        staged_history=scratch_path(t.spark, "staged_history"),
        public=f"{schema}.public",
    )
    load_consumer_response(
        t.spark, _response_file(t), RESPONSE_HEAD, ["unique_number"], RUN_DATE, targets, "2021-09-02 00:00:00.000"
    )
    dated = t.spark.read.parquet(targets.staged_history).where("import_month = '202108'").count()
    return t.spark.table(targets.public).select(
        "import_month",
        "accountid",
        "import_ts",
        "customer_reference_number",
        "last_name",
        "suffix",
        "applicant_guid",
        F.col("unique_number").cast("string").alias("unique_number"),
        F.lit(dated).cast("bigint").alias("dated_rows"),
    )


DETAIL_ROWS = Entity(
    "customer",
    (
        "cast(c_custkey as string) as `CUST REF NBR`",
        "concat(c_name, ', \"inc\"') as `NAME`",
        "c_mktsegment as `ADDRESS`",
        "case when c_acctbal > 0 then cast(c_nationkey as string) else '' end as `SEQUENCE NUMBER`",
        "concat('score ', c_mktsegment) as `Score Code2`",
    ),
)


RISK_ROWS = Entity(
    "customer",
    (
        "concat('r', cast(c_custkey as string)) as `Reference`",
        "case when c_nationkey > 3 then cast(c_custkey * 3 as string) else '' end as `Risk Score`",
        "c_mktsegment as `Risk Class`",
    ),
)
# A second, smaller specification: the 337 columns of the real one are a parameter.
RISK_SPEC = parse_spec(
    """
    reference          | Reference          | varchar(50)
    risk_score         | Risk Score         | number(38,0)?
    risk_class         | Risk Class         | varchar(4)
    imported_file_name | imported_file_name | varchar(100)
    import_month       | import_month       | varchar(6)
    import_ts          | import_ts          | timestamp
    """
)


@query(f"""
    select "CUST REF NBR" as cust_ref_nbr, "NAME" as name, cast(null as varchar) as telephone1,
      cast(nullif("SEQUENCE NUMBER", '') as double) as sequence_number, left("Score Code2", 5) as score_code2,
      'dv.parquet' as imported_file_name, '202108' as import_month, '2021-09-02 01:02:03' as import_ts, 'detail' as target
    from {DETAIL_ROWS.sql.replace('`', '"')}
    union all select "Reference", null, null, cast(nullif("Risk Score", '') as double), left("Risk Class", 4),
      'risk.parquet', '202108', '2021-09-02 01:02:03', 'risk'
    from {RISK_ROWS.sql.replace('`', '"')}
""")
def commercial_response_load(t: Tables):
    rows = DETAIL_ROWS.frame(t)
    sources = [c.source for c in DETAIL_SPEC if c.source and not c.source.startswith("import")]
    full = rows.select(*[F.col(f"`{s}`") if s in rows.columns else F.lit("").alias(s) for s in sources])
    place, schema = scratch_path(t.spark, "detail"), scratch_schema(t.spark, "commercial")
    table, risk_place, risk_table = f"{schema}.detail", scratch_path(t.spark, "risk"), f"{schema}.risk"
    write_csv(full, place)
    write_csv(RISK_ROWS.frame(t), risk_place)
    files = {
        "dv.parquet": (place, DETAIL_SPEC, table),
        "risk.parquet": (risk_place, RISK_SPEC, risk_table),
        "late.parquet": (place + "-missing", DETAIL_SPEC, table),
    }
    load_commercial_responses(t.spark, files, RUN_DATE, "2021-09-02 01:02:03.456")
    stamps = ["imported_file_name", "import_month", F.date_format("import_ts", "yyyy-MM-dd HH:mm:ss").alias("import_ts")]
    detail = t.spark.table(table).select(
        "cust_ref_nbr",
        "name",
        "telephone1",
        F.col("sequence_number").cast("double").alias("sequence_number"),
        "score_code2",
        *stamps,
        F.lit("detail").alias("target"),
    )
    nothing = F.lit(None).cast("string")
    risk = t.spark.table(risk_table).select(
        F.col("reference").alias("cust_ref_nbr"),
        nothing.alias("name"),
        nothing.alias("telephone1"),
        F.col("risk_score").cast("double").alias("sequence_number"),
        F.col("risk_class").alias("score_code2"),
        *stamps,
        F.lit("risk").alias("target"),
    )
    return detail.unionByName(risk)


@query("""
    select strftime(o_orderdate, '%Y%m') as import_month, count(*) as n, cast(sum(o_orderkey) as bigint) as keys
    from orders group by 1
""")
def dated_history(t: Tables):
    place = scratch_path(t.spark, "dated")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    month = F.date_format("o_orderdate", "yyyyMM")
    write_dated_copy(rows, place, month)
    # The closed orders arrive again: only their months are replaced, with all rows of them.
    again = rows.where("o_orderdate >= timestamp_ntz '1999-01-01'")
    write_dated_copy(again, place, month)
    dated = t.spark.read.option("basePath", place).parquet(place)
    counted = dated.groupBy(F.col("import_month").cast("string").alias("import_month"))
    return counted.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


_ELIGIBLE = f"""
    loans as (select distinct merchant_guid from {LOANS.sql}
      where facility_code <> 'O' and (outstanding_balance <> 0.0 or
        (state = 'closed' and datediff('day', try_cast(fully_repaid_at as date), date '{AS_OF}') <= 365)))
"""
_ADDRESS_COLUMNS = (
    "city, country_alpha_3, post_box_number, post_box_type, postal_code, premise_number, state_province, "
    "sub_premise_number, sub_premise_type, thoroughfare, rural_routes, rural_additional_content"
)
_CONSUMER_SQL = f"""
    with {_ELIGIBLE},
    wanted as (select primary_applicant_guid as g from {APPLICANT_MERCHANTS.sql} m
                 join loans l on m.guid = l.merchant_guid
               union select 'app_00000003' union select 'app_00000004'),
    attr as (select * from {union_sql(*ATTRIBUTES)}),
    homes as (select l.party_id, a.* from {APPLICANT_LINKS.sql} l left join {ADDRESSES.sql} a
                on l.address_id = a.address_id
              where party_type = 'Individuals::Applicant' and active = 't' and category = 'physical_address'),
    lines as (
      select distinct p.applicant_guid, encrypted_date_of_birth, encrypted_first_name, encrypted_last_name,
        encrypted_middle_name, x.encrypted_value as encrypted_suffix, s.encrypted_value as encrypted_sin,
        f.encrypted_value as encrypted_file_number, {_ADDRESS_COLUMNS}
      from {APPLICANTS.sql} p
      left join attr s on s.applicant_id = p.applicant_id and s.key = 'sin'
      left join attr x on x.applicant_id = p.applicant_id and x.key = 'suffix'
      left join attr f on f.applicant_id = p.applicant_id and f.key = 'file_number'
      left join homes h on h.party_id = p.applicant_id
      where p.applicant_guid in (select g from wanted) and p.applicant_guid <> 'app_00000005')
"""


def _consumer_request(
    t: Tables, applicants: DataFrame | None = None, attributes: DataFrame | None = None
) -> DataFrame:
    return consumer_request(
        APPLICANTS.frame(t) if applicants is None else applicants,
        union_frame(t, *ATTRIBUTES) if attributes is None else attributes,
        APPLICANT_LINKS.frame(t),
        ADDRESSES.frame(t),
        LOANS.frame(t),
        APPLICANT_MERCHANTS.frame(t),
        dt.date.fromisoformat(AS_OF),
        manual_guids=["app_00000003", "app_00000004"],
        excluded_guids=["app_00000005"],
    )


@query(f"""{_CONSUMER_SQL}
    select row_number() over (order by applicant_guid nulls first, encrypted_date_of_birth nulls first,
      encrypted_first_name nulls first, encrypted_last_name nulls first, encrypted_middle_name nulls first,
      encrypted_suffix nulls first, encrypted_sin nulls first, encrypted_file_number nulls first,
      {', '.join(c + ' nulls first' for c in (
          "city", "premise_number", "sub_premise_type", "thoroughfare", "rural_routes",
          "rural_additional_content", "country_alpha_3", "post_box_number", "post_box_type", "postal_code",
          "state_province", "sub_premise_number"))}) as id, *
    from lines
""")
def consumer_request_dataset(t: Tables):
    return _consumer_request(t)


@query(f"""{_CONSUMER_SQL}
    select applicant_guid, substr(line, 13) as line from (
      select applicant_guid, {_REQUEST_LINE} as line from (
        select *, {SQL_ADDRESS_LINES} as lines from (
          select 0 as id, applicant_guid, encrypted_last_name as last_name, encrypted_first_name as first_name,
            encrypted_middle_name as middle_name, encrypted_suffix as suffix, encrypted_sin as sin,
            encrypted_date_of_birth as date_of_birth, encrypted_file_number as file_number, {SQL_CLEAN_ADDRESS}
          from lines)))
""")
def consumer_request_chain(t: Tables):
    """Encrypted applicants to request lines (without the id, whose order follows the ciphertext)."""
    personal = ["first_name", "last_name", "middle_name", "date_of_birth"]
    applicants = sealed_columns(t, APPLICANTS.frame(t), "applicant_id", [f"encrypted_{c}" for c in personal])
    attributes = sealed_columns(t, union_frame(t, *ATTRIBUTES), "applicant_id", ["encrypted_value"])
    rows = _consumer_request(t, applicants, attributes)
    keys = key_table(t).select("wrapped_key", "data_key")
    plain = decrypt_columns(rows, [*personal, "suffix", "sin", "file_number"], keys, "id")
    guid = F.trim(F.substring("line", REQUEST_LAYOUT.starts[14] + 1, 25)).alias("applicant_guid")
    return consumer_lines(plain).select(guid, F.substring("line", 13, 208).alias("line"))


@query(f"{_CONSUMER_SQL} select count(*) as lines, count(distinct applicant_guid) as entities from lines")
def consumer_request_counts(t: Tables):
    return request_counts(_consumer_request(t), "applicant_guid")


_COMMERCIAL_SQL = f"""
    with {_ELIGIBLE},
    attr as (select * from {union_sql(*ATTRIBUTES)}),
    offices as (select l.party_id, a.* from {MERCHANT_LINKS.sql} l left join {ADDRESSES.sql} a
                  on l.address_id = a.address_id
                where party_type = 'Entities::Merchant' and active = 't' and category = 'legal_business_address'),
    phones as (select l.party_id, a.* from {PHONE_LINKS.sql} l left join {PHONES.sql} a
                 on l.phone_number_id = a.phone_number_id
               where party_type = 'Entities::Merchant' and active = 't' and category = 'business_phone_number'),
    lines as (
      select distinct m.merchant_guid, m.name, area_code, country_code, phone_number, {_ADDRESS_COLUMNS},
        f.encrypted_value as encrypted_file_number
      from {COMMERCIAL_MERCHANTS.sql} m
      left join offices o on o.party_id = try_cast(m.merchant_id as bigint)
      left join phones p on p.party_id = try_cast(m.merchant_id as bigint)
      left join attr f on f.business_id = m.business_id and f.key = 'file_number'
      where m.merchant_guid in (select merchant_guid from loans) and m.merchant_guid <> 'm_00000007')
"""


def _commercial_request(t: Tables) -> DataFrame:
    return commercial_request(
        COMMERCIAL_MERCHANTS.frame(t),
        union_frame(t, *ATTRIBUTES),
        MERCHANT_LINKS.frame(t),
        ADDRESSES.frame(t),
        PHONE_LINKS.frame(t),
        PHONES.frame(t),
        LOANS.frame(t),
        dt.date.fromisoformat(AS_OF),
        excluded_guids=["m_00000007"],
    )


@query(f"{_COMMERCIAL_SQL} select * from lines")
def commercial_request_dataset(t: Tables):
    # The ids follow the whole row; the check compares the rows behind them.
    return _commercial_request(t).drop("id")


@query(f"""{_COMMERCIAL_SQL}
    select reference_number, coalesce(name, '') as business_name, {SQL_ADDRESS_LINES} as address, city,
      state_province as province, postal_code, phone, '' as fax
    from (select merchant_guid as reference_number, name, {SQL_CLEAN_ADDRESS},
            coalesce(area_code, '') || coalesce(phone_number, '') as phone from lines)
""")
def commercial_request_csv(t: Tables):
    rows, place = commercial_rows(_commercial_request(t)), scratch_path(t.spark, "commercial")
    write_csv(rows, place, line_sep="\r\n")
    return read_csv(t.spark, place, rows.schema)


@query(f"""
    select address_id, {SQL_ADDRESS_LINES} as lines,
      concat_ws(' ', nullif({SQL_ADDRESS_LINES}, ''),
        city || ' ' || state_province || ' ' || country_alpha_3 || ' ' || postal_code) as full_text,
      '514' || lpad(cast(address_id as varchar), 7, '5') as phone
    from (select address_id, {SQL_CLEAN_ADDRESS} from {ADDRESSES.sql})
""")
def address_strings(t: Tables):
    return clean_address(ADDRESSES.frame(t)).select(
        "address_id",
        address_lines().alias("lines"),
        full_address().alias("full_text"),
        phone_text(F.lit("514"), F.lpad(F.col("address_id").cast("string"), 7, "5")).alias("phone"),
    )


@query(f"select doc_id, md5({sql_transliterate('text')}) as plain_md5, length({sql_transliterate('text')}) as n "
       "from documents")
def transliterate_text(t: Tables):
    plain = transliterate_fr(F.col("text"))
    return t.documents.select("doc_id", F.md5(plain).alias("plain_md5"), F.length(plain).cast("bigint").alias("n"))


@query("""
    select c_custkey, coalesce(trim(case when c_acctbal < 0 then null else '  ' || c_name || ' ' end), '') as name,
      case when c_nationkey = 0 then '' else cast(c_nationkey as varchar) end as nation
    from customer
""")
def text_of_values(t: Tables):
    padded = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return t.customer.select(
        "c_custkey",
        to_string(padded).alias("name"),
        to_string(F.col("c_nationkey"), numeric=True).alias("nation"),
    )


_RECORD_ID = "translate(substr(md5(c_name), 1, 15), 'abcdef', 'aBcDeF')"


@query(f"""
    with ids as (select c_custkey, {_RECORD_ID} as id from customer)
    select c_custkey, id || {' || '.join(
        "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ012345', 1 + " + " + ".join(
            f"case when substr(id, {b * 5 + j + 1}, 1) between 'A' and 'Z' then {1 << j} else 0 end"
            for j in range(5)) + ", 1)" for b in range(3))} as record_id
    from ids
""")
def record_ids(t: Tables):
    ids = t.customer.select("c_custkey", F.expr(_RECORD_ID).alias("id"))
    return ids.select("c_custkey", record_id_18(F.col("id")).alias("record_id"))


RUBY_TEXT = Entity(
    "events",
    (
        "event_id",
        # One object, or a list of two, as the source writes them.
        "case when event_type = 'view' then concat('[{\"id\"=>', cast(user_id as string), ', \"note\"=>nil}, ', "
        "'{\"id\"=>', cast(event_id as string), ', \"note\"=>\"', event_type, '\"}]') "
        "else concat('{\"id\"=>', cast(user_id as string), ', \"note\"=>\"', event_type, '\"}') end as body",
    ),
)


@query("""
    select event_id, user_id as id, case when event_type <> 'view' then event_type end as note from events
    union all select event_id, event_id, event_type from events where event_type = 'view'
""")
def ruby_hash_elements(t: Tables):
    parsed = F.from_json(ruby_hash_to_json(F.col("body")), "array<struct<id: bigint, note: string>>")
    return RUBY_TEXT.frame(t).select("event_id", F.explode(parsed).alias("e")).select("event_id", "e.id", "e.note")


@query("""
    select 'not_null' as check, 'o_custkey' as column, count(*) filter (where o_custkey is null) as failures from orders
    union all select 'not_null', 'o_orderdate', count(*) filter (where o_orderdate is null) from orders
    union all select 'accepted_values', 'o_orderstatus', count(*) filter (where o_orderstatus not in ('O', 'F')) from orders
    union all select 'unique', 'o_orderkey', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
    union all select 'unique', 'o_custkey', count(*) from (select 1 from orders group by o_custkey having count(*) > 1)
    union all select 'relationships', 'o_custkey', count(*) from orders
      where o_custkey not in (select c_custkey from customer where c_acctbal > 0)
""")
def table_checks(t: Tables):
    return checks_of(
        t.orders,
        not_null=["o_custkey", "o_orderdate"],
        unique=["o_orderkey", "o_custkey"],
        accepted={"o_orderstatus": ["O", "F"]},
        relationships={"o_custkey": (t.customer.where("c_acctbal > 0"), "c_custkey")},
    )


@query("""
    select case when c_custkey % 2 = 0 then 'comm' else 'cons' end as target,
      case when c_custkey % 2 = 0 then 'risk' else 'dv' end || '_' || cast(floor(c_custkey / 5000) as bigint) as file,
      count(*) as n, cast(sum(c_custkey) as bigint) as keys
    from customer group by 1, 2
""")
def file_discovery(t: Tables):
    """Landed files of a range of keys each, their targets, and what is in them."""
    place = scratch_path(t.spark, "inbox")
    kind = F.when(F.col("c_custkey") % 2 == 0, "risk").otherwise("dv")
    named = t.customer.withColumn("file", F.concat_ws("_", kind, F.floor(F.col("c_custkey") / 5000).cast("string")))
    named.repartition("file").write.partitionBy("file").parquet(place)
    files = list_files(t.spark, f"{place}/*", "part-").withColumn("name", F.regexp_extract("path", "file=([^/]+)/", 1))
    routed = route_files(files, "risk_", "comm", "cons").select(F.col("name").alias("file"), "target").distinct()
    held = t.spark.read.parquet(place).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))
    return routed.join(held, "file").select("target", "file", "n", "keys")
