"""Records of text files whose ends a single byte does not tell, read by many tasks a file.

CSV with line breaks in values, and JSON objects one behind the other. A file is cut at every separator (line feed, closing
brace) by Spark's text reader, so its splits are read in parallel. Whether a separator ends a record depends on all in front
of it: inside quotes or not, and how many braces are open. One pass tells, for each split, what it does to that state under
either begin; a prefix scan over the splits (one row each) gives the state in which each begins; a second pass then cuts
all splits at once. Only the pieces of records that cross a border of splits are shuffled.

Splits must be the same in both passes, which `millrace.session.tune` sees to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialize, tune

# The begin of every split is broadcast, some 150 bytes each: of 128 MB splits these are 250 TB.
MAX_SPLITS = 2_000_000

Marks = tuple[np.ndarray, np.ndarray, np.ndarray]


def _csv_marks(values: pa.Array) -> Marks:
    """Quotes in each line; braces do not count. A doubled quote inside a value changes nothing."""
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    return quotes, np.zeros_like(quotes), np.zeros_like(quotes)


def _json_marks(values: pa.Array) -> Marks:
    """Quotes that open or close a text, and how the depth changes if the part begins outside or inside of a text."""
    plain = pc.replace_substring_regex(values, r"(?s)\\.", "")
    quotes = pc.count_substring(plain, '"').to_numpy(zero_copy_only=False)

    def change(parts: pa.Array, inside: int) -> np.ndarray:
        left = pc.replace_substring_regex(parts, r'"[^"]*(?:"|\z)', "")
        return pc.count_substring(left, "{").to_numpy(zero_copy_only=False) - ((quotes + inside) % 2 == 0)

    return quotes, change(plain, 0), change(pc.binary_join_element_wise(pa.scalar('"'), plain, ""), 1)


class Format(NamedTuple):
    separator: str
    marks: Callable[[pa.Array], Marks]
    needs_separator: bool  # whether a record at the end of a file is only whole with its separator


CSV = Format("\n", _csv_marks, False)
JSON = Format("}", _json_marks, True)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Rows of one split each, in order, and whether they are the last of their split."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        split, file = batch.column("split").to_numpy(), batch.column("file")
        changes = np.flatnonzero(split[1:] != split[:-1]) + 1
        # Files of one split each all begin at 0.
        changes = np.union1d(changes, np.flatnonzero(pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)) + 1)
        for a, b in zip([0, *changes], [*changes, batch.num_rows], strict=True):
            part = batch.slice(int(a), int(b - a))
            if held is not None:
                yield held, any(held.column(c)[0] != part.column(c)[0] for c in ("file", "split"))
            held = part
    if held is not None:
        yield held, True


_SPLIT_DDL = "file string, split long, size long, quotes long, outside long, inside long, bytes long"


def _effects(kind: Format):
    """What each split does to the state: quotes, and the change of depth for a begin outside and inside of quotes."""

    def run(batches):
        quotes, bytes_read, change = 0, 0, [0, 0]
        for part, is_last in _stretches(batches):
            values = part.column("value")
            q, outside, inside = kind.marks(values)
            before = quotes + np.cumsum(q) - q
            for begin in (0, 1):
                change[begin] += int(np.where((before + begin) % 2 == 1, inside, outside).sum())
            quotes += int(q.sum())
            bytes_read += int(pc.sum(pc.binary_length(values)).as_py()) + len(values) * len(kind.separator)
            if is_last:
                row = [part.column(c)[0].as_py() for c in ("file", "split", "size")] + [quotes, *change, bytes_read]
                names = ["file", "split", "size", "quotes", "outside", "inside", "bytes"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])
                quotes, bytes_read, change = 0, 0, [0, 0]

    return run


def _begins(lines: DataFrame, kind: Format) -> DataFrame:
    """The state in which each split begins, and whether the file ends with it, without a last separator."""
    effects = materialize(lines.mapInArrow(_effects(kind), _SPLIT_DDL), "splits")
    if (n := effects.count()) > MAX_SPLITS:
        raise ValueError(f"{n} splits: raise spark.sql.files.maxPartitionBytes")
    per_file = W.partitionBy("file")
    before = per_file.orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    opened = effects.withColumn("begin", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("begin") == 1, F.col("inside")).otherwise(F.col("outside"))
    opened = opened.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    is_last = F.col("split") == F.max("split").over(per_file)
    missing = F.sum("bytes").over(per_file) == F.col("size") + len(kind.separator)
    return opened.select("file", "split", "begin", "depth", (is_last & missing).alias("cut"))


_WHOLE, _HEAD, _TAIL, _MIDDLE = range(4)
_RECORD_DDL = "file string, split long, kind int, first boolean, text string"


def _records(kind: Format):
    """Whole records, and pieces: the end of an open record (head), its begin (tail), a split without an end (middle)."""
    names = ["file", "split", "kind", "first", "text"]

    def run(batches):
        held: list[pa.Array] = []
        parity = depth = 0
        fresh, unopened, is_first = True, True, False
        for part, is_last in _stretches(batches):
            if fresh:
                parity, depth, cut = (part.column(c)[0].as_py() for c in ("begin", "depth", "cut"))
                unopened, fresh, held = not (parity or depth), False, []
                is_first = part.column("split")[0].as_py() == 0
            values = part.column("value")
            q, outside, inside = kind.marks(values)
            after = parity + np.cumsum(q)
            level = depth + np.cumsum(np.where((after - q) % 2 == 1, inside, outside))
            ends = (after % 2 == 0) & (level == 0)
            if is_last and cut and kind.needs_separator:
                ends[-1] = False
            parity, depth = int(after[-1]) % 2, int(level[-1])
            ends = np.flatnonzero(ends)
            kinds: list[int] = []
            texts: list[pa.Array] = []
            firsts: list[bool] = []
            if len(ends):
                parts = pa.concat_arrays([*held, values.slice(0, int(ends[0]) + 1)])
                kinds, firsts = [_WHOLE if unopened else _HEAD], [is_first]
                texts = [_joined(parts, np.array([0, len(parts)]), kind)]
                unopened, is_first = True, False
                rest = values.slice(int(ends[0]) + 1, int(ends[-1] - ends[0]))
                texts.append(_joined(rest, ends - ends[0], kind))
                kinds += [_WHOLE] * (len(ends) - 1)
                firsts += [False] * (len(ends) - 1)
                held = [values.slice(int(ends[-1]) + 1)]
            else:
                held.append(values)
            if is_last:
                parts = pa.concat_arrays(held)
                if len(parts):
                    kinds.append(_TAIL if unopened else _MIDDLE)
                    firsts.append(is_first)
                    texts.append(_joined(parts, np.array([0, len(parts)]), kind))
                fresh = True
            if kinds:
                file, split = (pa.repeat(part.column(c)[0], len(kinds)) for c in ("file", "split"))
                yield pa.RecordBatch.from_arrays([file, split, pa.array(kinds, pa.int32()), pa.array(firsts), pa.concat_arrays(texts)], names)

    return run


def _joined(parts: pa.Array, offsets: np.ndarray, kind: Format) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), kind.separator)


def records(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """file, first (at the begin of its file) and text of every record, in no order, without a last separator.

    Blank ones are left out. A file that ends within a record is an error when the record is read.
    """
    tune(spark)
    lines = spark.read.option("lineSep", kind.separator).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    begins = _begins(lines.select(*place, F.col("_metadata.file_size").alias("size"), "value"), kind)
    found = lines.select(*place, "value").join(F.broadcast(begins), ["file", "split"])
    cut = materialize(found.mapInArrow(_records(kind), _RECORD_DDL), "records")
    whole = cut.where(F.col("kind") == _WHOLE).select("file", "first", "text")
    # At most two pieces a split; each tail opens a record that later pieces go on with.
    number = F.count_if(F.col("kind") == _TAIL).over(W.partitionBy("file").orderBy("split", "kind"))
    pieces = cut.where(F.col("kind") != _WHOLE).withColumn("number", number)
    joined = pieces.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("split", "kind", "text"))).alias("parts"),
        F.bool_or(F.col("kind") == _HEAD).alias("ended"),
        F.bool_or("first").alias("first"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), kind.separator)
    joined = joined.withColumn("text", text).where(F.col("ended") | (F.trim(F.translate("text", "\r\n\t", "   ")) != ""))
    unfinished = F.raise_error(F.concat(F.lit("unfinished record at the end of "), "file"))
    joined = joined.select("file", "first", F.when(F.col("ended"), F.col("text")).otherwise(unfinished).alias("text"))
    return whole.union(joined).where(F.trim(F.translate("text", "\r\n\t", "   ")) != "")


def read_csv_splits(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, keep_empty: bool = True) -> DataFrame:
    """Quoted CSV whose values may hold line breaks, each file read by many tasks.

    Quotes inside of values are doubled, and only quoted values hold any. With `header` the first record of each file goes.
    An empty text cell is '' with `keep_empty`, else null. A cell that does not fit the schema is an error.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = records(spark, path, CSV)
    if header:
        rows = rows.where(~F.col("first"))
    # multiLine: line breaks in values stay as they are.
    how = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    parsed = F.from_csv(F.regexp_replace("text", "\r$", ""), kind.toDDL(), how)
    df = rows.select(parsed.alias("r")).select("r.*")
    if not keep_empty:
        return df
    texts = [f.name for f in kind.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in texts})


def read_json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON objects one behind the other, with or without blanks or line breaks in between or inside.

    Each file is read by many tasks. An object that is broken or does not fit the schema is an error.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    text = F.concat("text", F.lit(JSON.separator))
    rows = records(spark, path, JSON)
    return rows.select(F.from_json(text, kind, {"mode": "FAILFAST"}).alias("r")).select("r.*")
