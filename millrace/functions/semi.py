"""Semi-structured columns: landing as VARIANT, typed paths, hashes, base64."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_variant(df: DataFrame, name: str = "fields") -> DataFrame:
    """The whole row as one VARIANT value."""
    return df.select(F.to_variant_object(F.struct("*")).alias(name))


def path(variant: Column | str, key: str, data_type: str = "string") -> Column:
    """`variant:key::type`; a missing key or a failed cast is null."""
    return F.try_variant_get(variant, f'$["{key}"]', data_type)


def typed_paths(df: DataFrame, types: Mapping[str, str], fields: str = "fields") -> DataFrame:
    return df.select(*[path(fields, key, t).alias(key) for key, t in types.items()])


def row_hash(columns: list[str]) -> Column:
    """256-bit change hash over the named columns, nulls and names included."""
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.sha2(row, 256)


def base64_bytes(c: Column, url_safe: bool = False) -> Column:
    return F.unbase64(F.translate(c, "-_", "+/") if url_safe else c)


def base64_text(c: Column, url_safe: bool = False) -> Column:
    return base64_bytes(c, url_safe).cast("string")


def elements(json_text: Column) -> Column:
    """Array of VARIANT from JSON text that holds an array or a lone object.

    Unreadable text gives null.
    """
    value = F.try_parse_json(json_text)
    is_array = F.ltrim(json_text, F.lit(" \t\r\n")).startswith("[")
    many = F.try_variant_get(value, "$", "array<variant>")
    return F.when(is_array, many).otherwise(F.when(value.isNotNull(), F.array(value)))


def one_or_many(json_text: Column, element_schema: str) -> Column:
    """Like `elements`, with the elements as structs of a known schema."""
    return F.from_json(json_text, f"array<{element_schema}>")
