"""Fixed-width text: read lines, drop markers, slice, mask, render."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE, decode_bytes, escape_commas, fixed, strip
from millrace.sources.layout import HEADER_PREFIX, TRAILER_PREFIX, Layout

LINES_AT_ONCE = 500


def read_lines(spark: SparkSession, path: str, charset: str = "ISO-8859-1") -> DataFrame:
    """One row per line: `value` and `pos`, a sortable position of the line.

    Files split over tasks; blank lines are kept. Within a split the rows come
    in file order, so (file, start of split, running id) orders all lines.
    """
    raw = spark.read.text(path)
    value = F.col("value") if charset.upper() == "UTF-8" else decode_bytes(F.col("value"), charset)
    pos = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(value.alias("value"), pos.alias("pos"))


def drop_markers(
    lines: DataFrame, prefixes: Iterable[str] = (HEADER_PREFIX, TRAILER_PREFIX)
) -> DataFrame:
    value = F.col("value")
    for prefix in prefixes:
        lines = lines.where(~value.startswith(prefix))
    return lines


def slice_fields(
    value: Column, layout: Layout, mask: Sequence[str] = (), escape: bool = False
) -> list[Column]:
    """One stripped column per field; masked fields are empty, the last takes the rest."""
    out = []
    last = layout.names[-1]
    for (name, width), start in zip(layout.fields, layout.starts):
        if name in mask:
            out.append(F.lit("").alias(name))
            continue
        size = F.length(value) if name == last else F.lit(width)
        field = strip(F.substring(value, F.lit(start + 1), size))
        out.append((escape_commas(field) if escape else field).alias(name))
    return out


def _slice_batches(layout: Layout, mask: Sequence[str], escape: bool, wanted: Sequence[str]):
    spans = {
        name: (start, None if name == layout.names[-1] else start + width)
        for (name, width), start in zip(layout.fields, layout.starts)
    }

    def field(line: str | None, start: int, end: int | None) -> str | None:
        if line is None:
            return None
        text = line[start:end].strip(WHITESPACE)
        return text.replace(",", "\\,") if escape else text

    def cut(lines: list[str | None]) -> pd.DataFrame:
        return pd.DataFrame(
            {n: [""] * len(lines) if n in mask else [field(line, *spans[n]) for line in lines] for n in wanted}
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = batch["value"].tolist()
            # A thousand columns of a whole Arrow batch would be too many strings at once.
            for first in range(0, len(lines), LINES_AT_ONCE):
                yield cut(lines[first : first + LINES_AT_ONCE])

    return run


def parse(
    lines: DataFrame,
    layout: Layout,
    mask: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    escape: bool = False,
    in_batches: bool = False,
) -> DataFrame:
    """Slice `value` by the layout. Ask for `columns` to slice only those.

    One expression per field is costly to plan and compile for layouts of many
    hundred fields; `in_batches` slices Arrow batches instead, with the same
    result. A null line has null fields, masked ones are empty.
    """
    wanted = list(columns or layout.names)
    if not in_batches:
        sliced = dict(zip(layout.names, slice_fields(F.col("value"), layout, mask, escape)))
        return lines.select(*[sliced[name] for name in wanted])
    schema = ", ".join(f"`{name}` string" for name in wanted)
    return lines.select("value").mapInPandas(_slice_batches(layout, mask, escape, wanted), schema)


def render(layout: Layout, values: dict[str, Column]) -> Column:
    """One fixed-width line; fields without a value are blank."""
    unknown = set(values) - set(layout.names)
    if unknown:
        raise ValueError(f"not in the layout: {sorted(unknown)}")
    return F.concat(*[fixed(values.get(name, F.lit("")), width) for name, width in layout.fields])
