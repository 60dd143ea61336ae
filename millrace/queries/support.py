"""Registry of queries and the entities they derive from the test tables.

Entities are lists of SQL expressions that mean the same in Spark and in the
checking engine, so that a query and its check start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.crypto import seal
from millrace.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        # Kept, so that a query reads the schema of each table once.
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(check: str | None = None):
    """Register a function of `Tables` under its own name, with its SQL check."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        QUERIES[build.__name__] = run
        if check is not None:
            CHECKS[build.__name__] = check
        return build

    return register


@dataclass(frozen=True)
class Entity:
    """A projection (and filter) of one test table, or a union of such."""

    table: str
    columns: tuple[str, ...]
    where: str | None = None

    def frame(self, t: Tables) -> DataFrame:
        df = getattr(t, self.table)
        if self.where:
            df = df.where(self.where)
        return df.selectExpr(*self.columns)

    @property
    def sql(self) -> str:
        tail = f" where {self.where}" if self.where else ""
        return f"(select {', '.join(self.columns)} from {self.table}{tail})"


def union_frame(t: Tables, *entities: Entity) -> DataFrame:
    out = entities[0].frame(t)
    for more in entities[1:]:
        out = out.unionAll(more.frame(t))
    return out


def union_sql(*entities: Entity) -> str:
    return "(" + " union all ".join(f"select * from {e.sql}" for e in entities) + ")"


def guid(prefix: str, key: str) -> str:
    return f"concat('{prefix}_', lpad(cast({key} as string), 8, '0'))"


APPLICANTS = Entity(
    "customer",
    (
        "c_custkey as applicant_id",
        f"{guid('app', 'c_custkey')} as applicant_guid",
        "cast(date '1950-01-01' as string) as encrypted_date_of_birth",
        "c_name as encrypted_first_name",
        "concat(' Lévêque-', c_mktsegment) as encrypted_last_name",
        "case when c_acctbal > 5000 then 'Zoë' end as encrypted_middle_name",
    ),
)

APPLICANT_MERCHANTS = Entity(
    "customer",
    (
        f"{guid('m', 'c_custkey')} as guid",
        "c_name as name",
        # Customers in debt share the applicants with the lowest keys.
        f"{guid('app', 'case when c_acctbal >= 0 then c_custkey else c_nationkey end')} as primary_applicant_guid",
    ),
)

LOANS = Entity(
    "orders",
    (
        f"{guid('m', 'o_custkey')} as merchant_guid",
        "case when o_orderstatus = 'O' and o_totalprice > 400000 then o_totalprice else 0.0 end as outstanding_balance",
        "case when o_orderstatus <> 'O' then cast(cast(o_orderdate as date) as string) end as fully_repaid_at",
        "case when o_orderpriority = '5-LOW' then 'O' when o_orderpriority <> '1-URGENT' "
        "then substr(o_orderpriority, 1, 1) end as facility_code",
        "case when o_orderstatus = 'F' then 'closed' else 'open' end as state",
    ),
)
AS_OF = "2001-08-01"

_ATTRIBUTE_COLUMNS = ("c_custkey as applicant_id", "c_custkey as business_id")
ATTRIBUTES = (
    Entity(
        "customer",
        (*_ATTRIBUTE_COLUMNS, "'sin' as key", "lpad(cast(c_custkey as string), 9, '1') as encrypted_value"),
        "c_acctbal > 0",
    ),
    Entity(
        "customer",
        (*_ATTRIBUTE_COLUMNS, "'suffix' as key", "substr(c_mktsegment, 1, 2) as encrypted_value"),
        "c_mktsegment <> 'BUILDING'",
    ),
    Entity(
        "customer",
        (*_ATTRIBUTE_COLUMNS, "'file_number' as key", "cast(c_custkey * 7 as string) as encrypted_value"),
    ),
    # A second file number for some, so that a lookup fans out.
    Entity(
        "customer",
        (*_ATTRIBUTE_COLUMNS, "'file_number' as key", "cast(c_custkey * 11 as string) as encrypted_value"),
        "c_nationkey = 7",
    ),
)


def links(party: str, category: str, target: str) -> Entity:
    return Entity(
        "orders",
        (
            f"extract(month from o_orderdate) as {target}",
            "o_custkey as party_id",
            f"case when o_orderpriority = '3-MEDIUM' then 'Other::Party' else '{party}' end as party_type",
            "case when o_orderstatus = 'F' then 't' else 'f' end as active",
            f"case when o_totalprice > 250000 then '{category}' else 'mailing_address' end as category",
        ),
    )


APPLICANT_LINKS = links("Individuals::Applicant", "physical_address", "address_id")
MERCHANT_LINKS = links("Entities::Merchant", "legal_business_address", "address_id")
PHONE_LINKS = links("Entities::Merchant", "business_phone_number", "phone_number_id")

ADDRESSES = Entity(
    "supplier",
    (
        "s_suppkey as address_id",
        "concat('Montréal ', cast(s_nationkey as string)) as city",
        "'CAN' as country_alpha_3",
        "case when s_acctbal < 0 then cast(s_suppkey as string) end as post_box_number",
        "case when s_acctbal < 0 then 'CP' end as post_box_type",
        "'H3H1H1' as postal_code",
        "case when s_nationkey <> 3 then cast(s_suppkey + 100 as string) end as premise_number",
        "'QC' as state_province",
        "case when s_acctbal > 5000 then cast(s_nationkey as string) end as sub_premise_number",
        "case when s_acctbal > 8000 then 'Étage' end as sub_premise_type",
        "case when s_nationkey <> 3 then ' rue du Cœur ' end as thoroughfare",
        "case when s_nationkey > 20 then 'RR 2' end as rural_routes",
        "case when s_nationkey > 22 then 'Site É' end as rural_additional_content",
    ),
)

PHONES = Entity(
    "supplier",
    (
        "s_suppkey as phone_number_id",
        "'514' as area_code",
        "'1' as country_code",
        "lpad(cast(s_suppkey as string), 7, '5') as phone_number",
    ),
)

COMMERCIAL_MERCHANTS = Entity(
    "customer",
    (
        "case when c_mktsegment <> 'MACHINERY' then c_name end as name",
        "cast(c_custkey as string) as merchant_id",
        "c_custkey as business_id",
        f"{guid('m', 'c_custkey')} as merchant_guid",
    ),
)


def key_table(t: Tables) -> DataFrame:
    """One data key per nation, known by the wrapped form that envelopes carry."""
    name = F.col("n_nationkey").cast("string")
    wrapped = F.base64(F.encode(F.concat(F.lit("wrapped-"), name), "UTF-8"))
    return t.nation.select(
        "n_nationkey", wrapped.alias("wrapped_key"), F.unhex(F.md5(F.concat(F.lit("key-"), name))).alias("data_key")
    )


def sealed_columns(t: Tables, df: DataFrame, owner: str, columns: list[str]) -> DataFrame:
    """Replace text columns by their envelopes, under the key of one of the nations."""
    keys = key_table(t)
    nation = F.pmod(F.col(owner), F.lit(25)).cast("int")
    df = df.withColumn("n_nationkey", nation).join(keys, "n_nationkey")

    def sealed(name: str):
        nonce = F.substring(F.unhex(F.md5(F.concat_ws(":", F.lit(name), owner, name))), 1, 12)
        return seal(F.col(name), F.unbase64("wrapped_key"), F.col("data_key"), nonce)

    return df.withColumns({c: sealed(c) for c in columns}).drop(*keys.columns)


# SQL forms of shared expressions, for the checks only.
def sql_transliterate(c: str) -> str:
    return (
        f"translate(replace(replace({c}, 'Œ', 'Oe'), 'œ', 'oe'), "
        "'ÀàÂâÉéÈèÊêËëÎîÏïÔôÛûÙùÜüÇç', 'AaAaEeEeEeEeIiIiOoUuUuUuCc')"
    )


def sql_clean(c: str) -> str:
    return f"coalesce(trim({c}), '')"


SQL_CLEAN_ADDRESS = ", ".join(
    [
        f"{sql_transliterate(sql_clean(c))} as {c}"
        for c in (
            "city",
            "premise_number",
            "sub_premise_type",
            "thoroughfare",
            "rural_routes",
            "rural_additional_content",
        )
    ]
    + [
        f"{sql_clean(c)} as {c}"
        for c in (
            "country_alpha_3",
            "post_box_number",
            "post_box_type",
            "postal_code",
            "state_province",
            "sub_premise_number",
        )
    ]
)

SQL_ADDRESS_LINES = """
concat_ws(' ',
  nullif(case
    when premise_number = '' and thoroughfare = '' then ''
    when sub_premise_type <> '' and sub_premise_number <> ''
      then premise_number || ' ' || thoroughfare || ' ' || sub_premise_type || ' ' || sub_premise_number
    when sub_premise_number <> '' then sub_premise_number || '-' || premise_number || ' ' || thoroughfare
    else premise_number || ' ' || thoroughfare end, ''),
  nullif(case when post_box_type = '' and post_box_number = '' then ''
    else post_box_type || ' ' || post_box_number end, ''),
  nullif(case when rural_routes = '' then ''
    when rural_additional_content <> '' then rural_additional_content || ' ' || rural_routes
    else rural_routes end, ''))
"""
