"""Shards of near equal size in bytes, by histogram sort, with native expressions only.

Rows are ordered by a hash of their text, then one of their id, so equal texts lie together and a large group of
them can still be cut. The bytes and rows below candidate boundaries are counted exactly over all partitions: first
in even bins of the key space, then, where a boundary falls inside too large a bin or a bin holds too many rows, in
even bins between the smallest and largest key of that bin, until every splitter meets its tolerance. Only counts
reach the driver. Then the rows are exchanged once, by pieces of shards; a piece knows how many rows come before it
in its shard, which makes slots gapless without sorting a whole shard in one task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.session import materialize

SHARDS = 40
ROW_BYTES = 16
# A splitter may miss its place by this part of a shard, unless a single key stands there.
TOLERANCE = 0.002
# A shard is numbered in pieces: at least so many, and more where a piece would pass so many rows.
PIECES = 32
PIECE_ROWS = 2_000_000
_FIRST_BITS = 13
_BINS = 256
_KEY_BITS = 63


@dataclass(frozen=True)
class Bin:
    """Rows whose key lies in [low, high): keys are (text hash, id hash), compared in this order."""

    low: tuple[int, int]
    high: tuple[int, int]
    size: int
    rows: int

    @property
    def single(self) -> bool:
        """Nothing is left to divide: one key."""
        return self.low[0] == self.high[0] and self.high[1] - self.low[1] <= 1


def keys(text: Column, key: Column) -> tuple[Column, Column]:
    """63-bit hashes of the text and of the id, in which rows are ordered."""
    return F.shiftrightunsigned(F.xxhash64(text), 1), F.shiftrightunsigned(F.xxhash64(key), 1)


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


# Row keys against the key range of a row of bins or pieces.
_INSIDE = "struct(h, g) >= struct(h0 as h, g0 as g) and struct(h, g) < struct(h1 as h, g1 as g)"


def _coarse(h: Column) -> Column:
    return F.shiftright(h, _KEY_BITS - _FIRST_BITS)


def _histogram(rows: DataFrame, by: Sequence[str]) -> list:
    return (
        rows.groupBy(*by)
        .agg(
            F.sum("size").alias("size"),
            F.count(F.lit(1)).alias("rows"),
            F.min(F.struct("h", "g")).alias("least"),
            F.max(F.struct("h", "g")).alias("most"),
        )
        .collect()
    )


def _counted(rows: list) -> list[Bin]:
    """Bins cut down to the keys in them."""
    made = []
    for r in rows:
        low, (h, g) = tuple(r["least"]), tuple(r["most"])
        made.append(Bin(low, (h, g + 1), r["size"], r["rows"]))
    return made


def _divided(spark: SparkSession, narrow: DataFrame, bins: list[Bin]) -> list[Bin]:
    """Counts of even parts of each bin. The parts are by text hash, or by id hash where all texts are equal."""
    parts = []
    for i, b in enumerate(bins):
        by_text = b.high[0] > b.low[0]
        start, span = (b.low[0], b.high[0] + 1 - b.low[0]) if by_text else (b.low[1], b.high[1] - b.low[1])
        step = -(-span // _BINS)
        first, last = b.low[0] >> (_KEY_BITS - _FIRST_BITS), b.high[0] >> (_KEY_BITS - _FIRST_BITS)
        parts += [(c, i, *b.low, *b.high, by_text, start, step) for c in range(first, last + 1)]
    # One row per large bin and coarse bin that it meets: bins never span more than one, so it is as small as `bins`.
    held = spark.createDataFrame(
        parts, "coarse long, bin int, h0 long, g0 long, h1 long, g1 long, by_text boolean, start long, step long"
    )
    met = narrow.withColumn("coarse", _coarse(F.col("h"))).join(F.broadcast(held), "coarse").where(_INSIDE)
    return _counted(_histogram(met.withColumn("part", F.expr("(if(by_text, h, g) - start) div step")), ["bin", "part"]))


def count_bins(narrow: DataFrame, shards: int, tolerance: float, pieces: int, piece_rows: int) -> list[Bin]:
    """Bins in key order, fine enough for splitters within the tolerance and for pieces of the wanted size."""
    done: list[Bin] = _counted(_histogram(narrow.withColumn("coarse", _coarse(F.col("h"))), ["coarse"]))
    while True:
        done.sort(key=lambda b: b.low)
        total = sum(b.size for b in done)
        rows = sum(b.rows for b in done)
        most_rows = max(1, min(piece_rows, rows // (shards * pieces)))
        large: list[Bin] = []
        below = 0
        for b in done:
            # A target strictly inside the bin, farther from both of its ends than the tolerance.
            share = total / shards
            reach = max(1.0, tolerance * share)
            first = int((below + reach) // share) + 1
            cut = first < shards and below + reach < first * share < below + b.size - reach
            if b.rows > 1 and not b.single and (cut or b.rows > 2 * most_rows):
                large.append(b)
            below += b.size
        if not large:
            return done
        chosen = set(large)
        done = [b for b in done if b not in chosen] + _divided(narrow.sparkSession, narrow, large)


@dataclass(frozen=True)
class Piece:
    shard: int
    before: int  # rows of the shard in earlier pieces
    bins: tuple[Bin, ...]


def cut_pieces(bins: list[Bin], shards: int, pieces: int, piece_rows: int) -> list[Piece]:
    """Whole bins dealt to shards at the bin borders nearest to even shares, and to pieces inside shards."""
    ends = list(accumulate(b.size for b in bins))
    total = ends[-1] if ends else 0
    rows = sum(b.rows for b in bins)
    most_rows = max(1, min(piece_rows, rows // (shards * pieces)))
    borders = []
    for k in range(1, shards):
        target = total * k / shards
        at = bisect_left(ends, target)
        before = ends[at - 1] if at else 0
        borders.append(at + 1 if at < len(ends) and ends[at] - target <= target - before else at)
    made = []
    for shard, (a, b) in enumerate(zip([0, *borders], [*borders, len(bins)], strict=True)):
        before, held = 0, []
        for part in bins[a:b]:
            if held and sum(x.rows for x in held) + part.rows > most_rows:
                made.append(Piece(shard, before, tuple(held)))
                before, held = before + sum(x.rows for x in held), []
            held.append(part)
        if held:
            made.append(Piece(shard, before, tuple(held)))
    return made


def _places(spark: SparkSession, pieces: list[Piece]) -> DataFrame:
    """One row per coarse bin and piece in it: key range, piece, shard, rows before. At most bins plus pieces rows."""
    rows = []
    for number, piece in enumerate(pieces):
        low, high = piece.bins[0].low, piece.bins[-1].high
        shift = _KEY_BITS - _FIRST_BITS
        for coarse in sorted({b.low[0] >> shift for b in piece.bins}):
            rows.append((coarse, *low, *high, number, piece.shard, piece.before))
    return spark.createDataFrame(rows, "coarse long, h0 long, g0 long, h1 long, g1 long, piece int, shard int, before long")


def shard_by_bytes(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    pieces: int = PIECES,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """`df` with size (UTF-8 bytes and 16), shard (from 0) and slot (from 0, gapless in its shard, in key order).

    Shards have near equal bytes: a splitter misses its place by the tolerance at most, or by the rows of one key
    (same text and same id), which stay together. A null text counts 16 bytes. An empty table gives no rows. Columns
    of these three names in `df` are replaced.
    """
    spark = df.sparkSession
    h, g = keys(F.col(text), F.col(key))
    rows = df.drop("size", "shard", "slot").withColumns({"size": row_bytes(F.col(text)), "h": h, "g": g})
    narrow = materialize(rows.select("h", "g", "size"), "keys")
    bins = count_bins(narrow, shards, tolerance, pieces, piece_rows)
    places = _places(spark, cut_pieces(bins, shards, pieces, piece_rows))
    placed = rows.withColumn("coarse", _coarse(F.col("h"))).join(F.broadcast(places), "coarse").where(_INSIDE)
    slot = F.row_number().over(W.partitionBy("piece").orderBy("h", "g")) - 1 + F.col("before")
    return placed.withColumn("slot", slot).drop("h", "g", "coarse", "h0", "g0", "h1", "g1", "piece", "before")


def op4_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    # The checksum is of the text that was put into its shard, so the text goes through the exchange as in a real job.
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    return shard_by_bytes(documents).withColumn("text_crc32", crc).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op4_histogram_shards": op4_histogram_shards}
CHECKS: dict[str, str] = {}
