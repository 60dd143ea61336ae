"""Validation of fixed-width request files and table checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import DIGITS, LETTERS, POSTAL_PREFIX
from millrace.operators.joins import join_unique
from millrace.sources.layout import (
    HEADER_PREFIX,
    MARKER_SUFFIX,
    REQUEST_LAYOUT,
    TRAILER_PREFIX,
)

# Lengths of a content line, the header and the trailer, the
# first two with their newline; width of the trailer's row count.
LINE_LENGTH = 221
HEADER_LENGTH = 43
TRAILER_LENGTH = 50
COUNT_WIDTH = 8

ERROR_SCHEMA = "category string, guid string, value string"


def bad_sin(c: Column) -> Column:
    return ~c.rlike(DIGITS) & (c != " " * 9)


def bad_birth_date(c: Column) -> Column:
    month = F.substring(c, 1, 2).try_cast("int")
    day = F.substring(c, 3, 2).try_cast("int")
    in_range = month.between(1, 12) & day.between(1, 31)
    return ~c.rlike(DIGITS) | ~F.coalesce(in_range, F.lit(False))


def is_blank(c: Column) -> Column:
    return F.trim(c) == ""


def bad_province(c: Column) -> Column:
    return ~c.rlike(LETTERS)


def bad_postal_code(c: Column) -> Column:
    return ~c.rlike(POSTAL_PREFIX) & (c != " " * 6)


def header_error(header: Column) -> Column:
    """First fault of the header line (newline included), null when it is fine."""
    return (
        F.when(F.length(header) != HEADER_LENGTH, F.concat(F.lit("length error: "), F.length(header)))
        .when(~header.startswith(HEADER_PREFIX), F.concat(F.lit("prefix error: "), header))
        .when(~header.endswith(MARKER_SUFFIX + "\n"), F.concat(F.lit("suffix error: "), header))
    )


def trailer_error(trailer: Column, content_lines: Column) -> Column:
    """First fault of the trailer line, null when it is fine."""
    marker = F.substring(trailer, 1, TRAILER_LENGTH - COUNT_WIDTH)
    count = F.substring(trailer, TRAILER_LENGTH - COUNT_WIDTH + 1, COUNT_WIDTH)
    stated = count.try_cast("long")
    return (
        F.when(F.length(trailer) != TRAILER_LENGTH, F.concat(F.lit("length error: "), F.length(trailer)))
        .when(~trailer.startswith(TRAILER_PREFIX), F.concat(F.lit("prefix error: "), trailer))
        .when(~marker.endswith(MARKER_SUFFIX), F.concat(F.lit("suffix error: "), trailer))
        .when(
            ~stated.eqNullSafe(content_lines),
            F.concat(F.lit("count error: "), F.coalesce(stated.cast("string"), count)),
        )
    )


def content_errors(lines: DataFrame) -> DataFrame:
    """One row per broken rule of the content lines in `value`.

    A line is checked with its newline, as read. A field that is empty because
    the line is too short breaks no rule of its own; the length rule reports it.
    """
    line = F.concat("value", F.lit("\n"))
    starts = dict(zip(REQUEST_LAYOUT.names, REQUEST_LAYOUT.starts))
    widths = dict(REQUEST_LAYOUT.fields)

    def field(name: str) -> Column:
        return F.substring(line, starts[name] + 1, widths[name])

    # The applicant id and the reserved field behind it.
    guid = F.rtrim(F.rtrim(F.substring(line, F.lit(starts["applicant_guid"] + 1), F.length(line)), F.lit("\n")))
    rules = {
        "sin": ("sin", bad_sin),
        "dob": ("date_of_birth", bad_birth_date),
        "address": ("civic_line", is_blank),
        "city": ("city", is_blank),
        "province": ("province_code", bad_province),
        "postal": ("postal_code", bad_postal_code),
    }
    no_guid = F.lit(None).cast("string")
    length = F.length(line)
    found = [
        F.when(
            length != LINE_LENGTH,
            F.struct(F.lit("length").alias("category"), no_guid.alias("guid"), length.cast("string").alias("value")),
        )
    ]
    for category, (name, broken) in rules.items():
        value = field(name)
        error = F.struct(F.lit(category).alias("category"), guid.alias("guid"), value.alias("value"))
        found.append(F.when(broken(value) & (value != ""), error))
    return lines.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*")


def validate_lines(lines: DataFrame) -> DataFrame:
    """All faults of a request file, as (category, guid, value); none means valid.

    `lines` has `value` and a sortable `pos`. One aggregation finds the first
    and last line and the count; the content is then checked where it lies.
    """
    ends = lines.agg(
        F.min_by("value", "pos").alias("header"),
        F.max_by("value", "pos").alias("trailer"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    no_guid = F.lit(None).cast("string")
    marks = ends.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("header").alias("category"),
                    no_guid.alias("guid"),
                    header_error(F.concat("header", F.lit("\n"))).alias("value"),
                ),
                F.struct(
                    F.lit("footer").alias("category"),
                    no_guid.alias("guid"),
                    trailer_error(F.col("trailer"), F.col("n") - 2).alias("value"),
                ),
            )
        ).alias("e")
    ).select("e.*")
    # One row with two positions: small by construction, so literals.
    row = ends.select("first", "last").first()
    pos_type = lines.schema["pos"].dataType
    first, last = (_literal(row[name], pos_type) for name in ("first", "last"))
    content = lines.where((F.col("pos") != first) & (F.col("pos") != last))
    return marks.where("value is not null").unionByName(content_errors(content))


def _literal(value, data_type) -> Column:
    if isinstance(value, tuple):
        fields = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, data_type.fields)]
        return F.struct(*fields)
    return F.lit(value)


def is_valid(errors: DataFrame) -> bool:
    """Gate: only a file without faults is handed on."""
    return errors.isEmpty()


def table_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: dict[str, Sequence] | None = None,
    relationships: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Failing rows per check: (check, column, failures).

    Not-null and accepted-values share one scan. A unique check counts the
    values that occur more than once, which combines before the shuffle.
    """
    n = F.count(F.lit(1)).alias("failures")
    single = {("not_null", c): F.col(c).isNull() for c in not_null}
    for c, values in (accepted or {}).items():
        single[("accepted_values", c)] = ~F.col(c).isin(list(values))
    results = []
    if single:
        counts = df.agg(*[F.count_if(bad).alias(f"{kind}|{c}") for (kind, c), bad in single.items()])
        rows = [
            F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column"), F.col(f"`{kind}|{c}`").alias("failures"))
            for kind, c in single
        ]
        results.append(counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in unique:
        copies = df.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1")
        results.append(copies.agg(n).select(F.lit("unique").alias("check"), F.lit(c).alias("column"), "failures"))
    for c, (parent, parent_key) in (relationships or {}).items():
        keys = parent.select(F.col(parent_key).alias(c)).distinct()
        orphans = join_unique(df.where(F.col(c).isNotNull()), keys, [c], "left_anti")
        results.append(orphans.agg(n).select(F.lit("relationships").alias("check"), F.lit(c).alias("column"), "failures"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
