"""Address and phone strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_name, to_string

# The address attributes; the first group is also transliterated.
TRANSLITERATED_FIELDS = (
    "city",
    "premise_number",
    "sub_premise_type",
    "thoroughfare",
    "rural_routes",
    "rural_additional_content",
)
PLAIN_FIELDS = (
    "country_alpha_3",
    "post_box_number",
    "post_box_type",
    "postal_code",
    "state_province",
    "sub_premise_number",
)
ADDRESS_FIELDS = TRANSLITERATED_FIELDS + PLAIN_FIELDS


def clean_address(df: DataFrame) -> DataFrame:
    """Every address field as stripped text, empty when missing."""
    cleaned = {name: clean_name(F.col(name)) for name in TRANSLITERATED_FIELDS}
    cleaned |= {name: to_string(F.col(name)) for name in PLAIN_FIELDS}
    return df.withColumns(cleaned)


def _spaced(*parts: Column) -> Column:
    """Parts joined with single spaces; empty parts keep their space."""
    return F.concat_ws(" ", *parts)


def civic_line() -> Column:
    number, street = F.col("premise_number"), F.col("thoroughfare")
    unit_type, unit = F.col("sub_premise_type"), F.col("sub_premise_number")
    return (
        F.when((number == "") & (street == ""), "")
        .when((unit_type != "") & (unit != ""), _spaced(number, street, unit_type, unit))
        .when(unit != "", _spaced(F.concat(unit, F.lit("-"), number), street))
        .otherwise(_spaced(number, street))
    )


def post_box_line() -> Column:
    kind, number = F.col("post_box_type"), F.col("post_box_number")
    return F.when((kind == "") & (number == ""), "").otherwise(_spaced(kind, number))


def rural_line() -> Column:
    route, extra = F.col("rural_routes"), F.col("rural_additional_content")
    return F.when((route == "") | (extra == ""), route).otherwise(_spaced(extra, route))


def municipal_line() -> Column:
    return _spaced(*[F.col(c) for c in ("city", "state_province", "country_alpha_3", "postal_code")])


def address_lines() -> Column:
    """Civic, post box and rural lines, empty ones left out, joined with a space.

    Expects cleaned fields (`clean_address`).
    """
    lines = (civic_line(), post_box_line(), rural_line())
    return F.concat_ws(" ", *[F.nullif(line, F.lit("")) for line in lines])


def full_address() -> Column:
    return F.concat_ws(" ", F.nullif(address_lines(), F.lit("")), municipal_line())


def phone_text(area: Column, number: Column) -> Column:
    return F.concat(to_string(area), to_string(number))
