"""Typed projection of loosely typed rows, from a column specification."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TypedColumn:
    """`kind` is varchar(n), number(p,s), date, timestamp or null (a constant null).

    `empty_is_null` turns '' into null before a cast.
    """

    target: str
    source: str
    kind: str
    empty_is_null: bool = False


_SIZED = re.compile(r"(varchar|number)\((\d+)(?:,(\d+))?\)")


def parse_spec(text: str) -> list[TypedColumn]:
    """Lines of `target | source | kind`; a trailing `?` on the kind means '' is null."""
    spec = []
    for line in text.strip().splitlines():
        target, source, kind = (part.strip() for part in line.split("|"))
        spec.append(TypedColumn(target, source, kind.removesuffix("?"), kind.endswith("?")))
    return spec


def typed_column(
    spec: TypedColumn,
    read: Callable[[str], Column],
    strict: bool,
    date_format: str,
    timestamp_format: str,
) -> Column:
    if spec.kind == "null":
        return F.lit(None).cast("string").alias(spec.target)
    value = read(spec.source).cast("string")
    if spec.empty_is_null:
        value = F.nullif(value, F.lit(""))
    sized = _SIZED.fullmatch(spec.kind)
    if sized and sized.group(1) == "varchar":
        # A cast to varchar(n) would not cut the text.
        typed = F.substring(value, 1, int(sized.group(2)))
    elif sized:
        decimal = f"decimal({sized.group(2)},{sized.group(3) or 0})"
        typed = value.cast(decimal) if strict else value.try_cast(decimal)
    elif spec.kind == "date":
        typed = F.try_to_date(value, date_format)
    elif spec.kind == "timestamp":
        typed = F.try_to_timestamp(value, F.lit(timestamp_format))
    else:
        raise ValueError(f"unknown kind {spec.kind!r} of {spec.target!r}")
    return typed.alias(spec.target)


def typed_select(
    df: DataFrame,
    spec: list[TypedColumn],
    read: Callable[[str], Column] | None = None,
    strict: bool = False,
    date_format: str = "yyyy-MM-dd",
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSS",
) -> DataFrame:
    """Cast every column of the spec; `strict` fails on a bad number instead of null.

    `read` fetches a source value, by default the column of that name; give
    `semi.path` on a VARIANT to load landed rows.
    """
    read = read or (lambda name: F.col(f"`{name}`"))
    return df.select(
        *[typed_column(c, read, strict, date_format, timestamp_format) for c in spec]
    )


# The commercial detail response, by source header.
DETAIL_SPEC = parse_spec(
    """
    cust_ref_nbr            | CUST REF NBR             | varchar(50)
    name                    | NAME                     | varchar(90)
    address                 | ADDRESS                  | varchar(150)
    city                    | CITY                     | varchar(50)
    province_code           | PROVINCE CODE            | varchar(50)
    postal_code             | POSTAL CODE              | varchar(50)
    telephone               | TELEPHONE                | varchar(50)
    telephone1              |                          | null
    sequence_number         | SEQUENCE NUMBER          | number(38,0)?
    company_number          | COMPANY NUMBER           | number(38,0)?
    efx_reserve_avro_hitflag | EFX Reserve AVRO HitFlag | number(38,0)?
    score_code2             | Score Code2              | varchar(5)
    score_description2      | Score Description2       | varchar(150)
    score_value2            | Score value2             | varchar(5)
    reason_code2_1          | Reason Code2 1           | varchar(5)
    reason_code2_1_desc     | Reason Code2 1 Desc      | varchar(150)
    reason_code2_2          | Reason Code2 2           | varchar(5)
    reason_code2_2_desc     | Reason Code2 2 Desc      | varchar(150)
    reason_code2_3          | Reason Code2 3           | varchar(5)
    reason_code2_3_desc     | Reason Code2 3 Desc      | varchar(150)
    reason_code2_4          | Reason Code2 4           | varchar(5)
    reason_code2_4_desc     | Reason Code2 4 Desc      | varchar(150)
    reason_code2_5          | Reason Code2 5           | varchar(5)
    reason_code2_5_desc     | Reason Code2 5 Desc      | varchar(150)
    reject_code2            | Reject Code2             | varchar(5)
    reject_code_desc2       | Reject Code Desc2        | varchar(150)
    model_number2           | Model Number2            | number(38,0)?
    score_code3             | Score Code3              | varchar(5)
    score_description3      | Score Description3       | varchar(150)
    score_value3            | Score value3             | varchar(5)
    reason_code3_1          | Reason Code3 1           | varchar(5)
    reason_code3_1_desc     | Reason Code3 1 Desc      | varchar(150)
    reason_code3_2          | Reason Code3 2           | varchar(5)
    reason_code3_2_desc     | Reason Code3 2 Desc      | varchar(150)
    reason_code3_3          | Reason Code3 3           | varchar(5)
    reason_code3_3_desc     | Reason Code3 3 Desc      | varchar(150)
    reason_code3_4          | Reason Code3 4           | varchar(5)
    reason_code3_4_desc     | Reason Code3 4 Desc      | varchar(150)
    reason_code3_5          | Reason Code3 5           | varchar(5)
    reason_code3_5_desc     | Reason Code3 5 Desc      | varchar(150)
    reject_code3            | Reject Code3             | varchar(5)
    reject_code_desc3       | Reject Code Desc3        | varchar(150)
    model_number3           | Model Number3            | number(38,0)?
    imported_file_name      | imported_file_name       | varchar(250)
    import_month            | import_month             | varchar(6)
    import_ts               | import_ts                | timestamp
    """
)
