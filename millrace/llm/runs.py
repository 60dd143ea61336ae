"""Periodic runs of words by an enhanced suffix array.

Suffixes of the words are sorted by prefix doubling; only suffixes that still share a rank are sorted again. The ranks of
each doubling give the common prefix (LCP) of neighbours. LCP intervals are found with range minima, and no tree is
built. A square of period d that one word to the right ends shows as two suffixes d words apart that lie in different
children of an interval of depth d. So all children of an interval but its largest are walked, and for each suffix i the
inverse suffix array tells whether i + d or i - d is in the interval too and in another child: n log n tests. Each such
square is rotated to the left as long as it stays one, and is then a run; squares of a multiple of the period give the
same stretch, of which the least period is kept.

Texts of one Arrow batch are worked on together: first ranks are of (text, word), so suffixes of two texts share nothing.
A text is one row and never cut; it needs some 300 bytes a word in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import table, text_chunks
from millrace.llm.rangemin import RangeMin

MIN_LENGTH = 24
MIN_POWER = 3
_BATCH = 1 << 20  # code points worked on together
_CELLS = 1 << 21  # word pairs compared at once


class SuffixArray(NamedTuple):
    order: np.ndarray  # suffixes in order
    rank: np.ndarray  # its inverse
    lcp: np.ndarray  # words that a suffix in order shares with the one before it; -1 for the first


def suffix_array(key: np.ndarray, stop: np.ndarray) -> SuffixArray:
    """Sort the suffixes of some sequences. `key`: symbols, different in different sequences; `stop`: where each ends."""
    n = len(key)
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    single = fresh & np.append(fresh[1:], True)
    pending = order[~single]
    levels, width = [rank.astype(np.int32)], 1
    while len(pending):
        behind = pending + width
        second = np.where(behind < stop[pending], rank[np.minimum(behind, n - 1)], -1)
        pair = rank[pending] * (n + 1) + second + 1
        by_pair = np.argsort(pair, kind="stable")
        pending, pair = pending[by_pair], pair[by_pair]
        fresh = np.append(True, pair[1:] != pair[:-1])
        old = rank[pending]
        opens = np.append(True, old[1:] != old[:-1])
        at = np.arange(len(pending))
        group = np.maximum.accumulate(np.where(opens, at, 0))
        rank[pending] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - group
        pending = pending[~(fresh & np.append(fresh[1:], True))]
        levels.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)

    left, right = order[:-1].copy(), order[1:].copy()
    ends = stop[left], stop[right]
    shared = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left < ends[0]) & (right < ends[1])
        level = levels[k]
        same = inside & (level[np.minimum(left, n - 1)] == level[np.minimum(right, n - 1)])
        for part in (left, right, shared):
            part[same] += 1 << k
    return SuffixArray(order, rank, np.append(-1, shared))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each stretch, one stretch behind the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first, size)


def branching_squares(array: SuffixArray, begin: np.ndarray, stop: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and period of each square that no word to its right continues, of at most length / `power` words a period."""
    order, rank, lcp = array
    border = np.flatnonzero(lcp > 0)
    at = order[border]
    border = border[lcp[border] * power <= stop[at] - begin[at]]
    depth = lcp[border]
    minima = RangeMin(lcp)
    low, high = minima.left(border - 1, depth), minima.right(border, depth)

    by_interval = np.lexsort((border, depth, low))
    border, depth, low, high = border[by_interval], depth[by_interval], low[by_interval], high[by_interval]
    opens = np.append(True, (low[1:] != low[:-1]) | (depth[1:] != depth[:-1]))[: len(border)]
    interval = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    # Children: one from the interval's begin, one from each border.
    child_low = np.insert(border, first, low[first])
    child_of = np.insert(interval, first, np.arange(len(first)))
    last = np.append(child_of[1:] != child_of[:-1], True)[: len(child_of)]
    child_high = np.where(last, high[first][child_of], np.append(child_low[1:], 0)[: len(child_low)] - 1)
    size = child_high - child_low + 1
    largest = np.lexsort((-size, child_of))[np.flatnonzero(np.append(True, child_of[1:] != child_of[:-1])[: len(child_of)])]
    small = np.ones(len(size), bool)
    small[largest] = False

    places, periods = [], []
    chosen = np.flatnonzero(small)
    # In slices, so that what is held stays in proportion to the words.
    bounds = np.searchsorted(np.cumsum(size[chosen]), np.arange(0, int(size[chosen].sum()) + _CELLS, _CELLS))
    for a, b in zip(np.append(0, bounds[1:-1] + 1), np.append(bounds[1:-1] + 1, len(chosen)), strict=True):
        part = chosen[a:b]
        if not len(part):
            continue
        row = _spread(child_low[part], size[part])
        child = np.repeat(part, size[part])
        of = first[child_of[child]]
        here, step = order[row], depth[of]
        for there, is_square in ((here + step, True), (here - step, False)):
            met = (there < stop[here]) & (there >= begin[here])
            other = rank[np.where(met, there, 0)]
            met &= (other >= low[of]) & (other <= high[of]) & ((other < child_low[child]) | (other > child_high[child]))
            places.append((here if is_square else there)[met])
            periods.append(step[met])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, period = np.concatenate(places), np.concatenate(periods)
    by_place = np.lexsort((period, place))
    place, period = place[by_place], period[by_place]
    fresh = np.append(True, (place[1:] != place[:-1]) | (period[1:] != period[:-1]))[: len(place)]
    return place[fresh], period[fresh]


def _rotated(key: np.ndarray, begin: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Where each square begins after it was rotated to the left as far as it stays one."""
    start, floor = place.copy(), begin[place]
    moving, width = np.arange(len(place)), 8
    while len(moving):
        width = min(2 * width, 1 << 14)
        rows = max(1, _CELLS // width)
        kept = []
        for a in range(0, len(moving), rows):
            part = moving[a : a + rows]
            back = start[part][:, None] - 1 - np.arange(width)
            inside = back >= floor[part][:, None]
            back = np.maximum(back, 0)
            same = inside & (key[back] == key[back + period[part][:, None]])
            steps = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
            start[part] -= steps
            kept.append(part[steps == width])
        moving = np.concatenate(kept)
    return start


def _merged(key: np.ndarray, begin: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and least period of the runs that some squares lie in, each run once.

    A run ends where its squares end. Of the squares with one end that of the least period is rotated first; the others
    inside its run are of multiples of the period and go. What is left lies in longer runs and comes in the next round.
    """
    end = place + 2 * period
    by_end = np.lexsort((period, end))
    place, period, end = place[by_end], period[by_end], end[by_end]
    starts, ends, periods = [place[:0]], [place[:0]], [place[:0]]
    while len(place):
        first = np.append(True, end[1:] != end[:-1])
        start = _rotated(key, begin, place[first], period[first])
        starts.append(start)
        ends.append(end[first])
        periods.append(period[first])
        left = place < start[np.cumsum(first) - 1]
        place, period, end = place[left], period[left], end[left]
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(periods)


class Found(NamedTuple):
    words: list[bytes]
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    def dropped(self) -> np.ndarray:
        """Words that some run contains behind its first period."""
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, self.start + self.period, 1)
        np.add.at(change, self.start + self.length, -1)
        return np.cumsum(change[:-1]) > 0

    def collapsed(self) -> bytes:
        """The kept words, joined by one blank."""
        if not len(self.start):
            return b" ".join(self.words)
        return b" ".join([w for w, gone in zip(self.words, self.dropped().tolist(), strict=True) if not gone])


def runs_of(texts: Sequence[str | None], min_length: int = MIN_LENGTH, power: int = MIN_POWER) -> Iterator[Found]:
    """Runs of each text by start, then period: least period q, length >= max(min_length, power * q); power >= 2.

    Words are what blanks and the control characters 9 to 13 separate. Null has no words.
    """
    # bytes.split cuts at exactly these characters.
    words = [text.encode().split() if text else [] for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    number: dict[bytes, int] = {}
    keys = [number.setdefault(w, len(number)) for some in words for w in some]
    nothing = np.empty(0, np.int64)
    if not keys:
        yield from (Found(some, nothing, nothing, nothing) for some in words)
        return
    text_of = np.repeat(np.arange(len(words)), sizes)
    key = np.array(keys, np.int64) + text_of * len(number)
    del keys, number
    begin, stop = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    place, period = branching_squares(suffix_array(key, stop), begin, stop, power)
    start, end, period = _merged(key, begin, place, period)
    long = end - start >= np.maximum(min_length, power * period)
    start, end, period = start[long], end[long], period[long]
    in_order = np.lexsort((period, start))
    start, end, period = start[in_order], end[in_order], period[in_order]
    cut = np.searchsorted(start, ends)
    first = 0
    for some, base, last in zip(words, (ends - sizes).tolist(), cut.tolist(), strict=True):
        yield Found(some, start[first:last] - base, (end - start)[first:last], period[first:last])
        first = last


def _mapped(df: DataFrame, text: str, fields: list[T.StructField], rows_of, keep: Sequence[str] | None, min_length: int, power: int) -> DataFrame:
    """The columns `keep` of `df`, then each tuple that `rows_of(found)` gives as `fields`."""
    if power < 2:
        raise ValueError("a run is at least a square")
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))
    types = [pa.string() if f.dataType == T.StringType() else pa.int64() for f in fields]

    def run(batches):
        for batch in batches:
            for first, texts in text_chunks(batch.column(len(kept)), _BATCH):
                made, source = [[] for _ in fields], []
                for number, found in enumerate(runs_of(texts, min_length, power)):
                    for values in rows_of(found):
                        source.append(first + number)
                        for column, value in zip(made, values, strict=True):
                            column.append(value)
                if source:
                    part = batch.take(pa.array(source, pa.int64()))
                    new = [pa.array(c, t) for c, t in zip(made, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], [*kept, *(f.name for f in fields)])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *fields]))


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def find_runs(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None, min_length: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """One row per run: the columns `keep` of `df` (all, if not given), start (word number), length and period.

    Repeated rows give their runs each. A null or empty text has none. Columns of `df` with the new names are replaced.
    """
    return _mapped(df, text, _longs("start", "length", "period"), lambda f: zip(f.start.tolist(), f.length.tolist(), f.period.tolist(), strict=True), keep, min_length, power)


def collapse_runs(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None, min_length: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """The columns `keep` of `df` (all, if not given) and `collapsed`: the words of each text, of each run one period only.

    Words are joined by one blank. A null text has none and gives an empty text.
    """
    return _mapped(df, text, [T.StructField("collapsed", T.StringType())], lambda f: [(f.collapsed().decode(),)], keep, min_length, power)


def run_digests(df: DataFrame, text: str = "text", keep: Sequence[str] | None = None, min_length: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """n_runs; start, length, period, exponent_milli of the run of the greatest length / period; runs and text as SHA-256."""

    def row(found: Found):
        listed = list(zip(found.start.tolist(), found.length.tolist(), found.period.tolist(), strict=True))
        best = None
        for start, length, period in listed:
            # In order of start and period, so the first of equals stays; fractions compared by whole numbers.
            if best is None or length * best[2] > best[1] * period:
                best = start, length, period
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
        return [(len(listed), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(found.collapsed()).hexdigest())]

    fields = [*_longs("n_runs", "start", "length", "period", "exponent_milli"),
              T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())]
    return _mapped(df, text, fields, row, keep, min_length, power)


def made_periodic(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, by a checksum of their id, repeats itself from some word on.

    Words of such a text are joined by one blank; other texts stay as they are. A null id chooses nothing.
    """
    rows = documents.select("doc_id", "text", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("h"))
    words = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
    rows = rows.withColumn("words", F.expr(f"case when h % 10 = 0 then {words} end"))
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.expr("case when n > 0 then cast(g % n as int) end"))
    rows = rows.withColumn("p", F.expr("case when n > 0 then cast(1 + (n - a) div (3 + g % 8) as int) end"))
    made = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(made_periodic(table(spark, folder, "documents")), keep=["doc_id"])


# CRC-32 of a decimal number `{}` as text, over the rows of `crc_list`.
SQL_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}::varchar) + 1), "
    "lambda i: ascii(substr({0}::varchar, i, 1))::bigint)), "
    "lambda c, b: xor(c >> 8, crc[(xor(c & 255, b) + 1)::int])), 4294967295)"
)
SQL_CRC_TABLE = """
crc_table as (
  select k, list_reduce(list_prepend(k, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
  from (select unnest(range(256))::bigint as k)),
crc_list as (select list(v order by k) as crc from crc_table)
"""
_SQL = f"""
with {SQL_CRC_TABLE},
cut as (select doc_id, {SQL_CRC32.format("doc_id")} as h,
  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents, crc_list),
numbers as (select *, len(words) as n, h // 10 as g from cut),
planted as (select *, h % 10 = 0 and n > 0 as made, case when n > 0 then g % n end as a from numbers),
texts as (select doc_id, n, case when made then list_transform(range(n), lambda i: words[(case when i < a then i
    else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end + 1)::int]) else words end as words from planted),
word as (select doc_id, n, unnest(words) as w, generate_subscripts(words, 1) - 1 as i from texts),
pairs as (select x.doc_id, x.i, y.i - x.i as q, x.i - row_number() over (partition by x.doc_id, y.i - x.i order by x.i) as island
  from word x join word y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i and 3 * (y.i - x.i) <= x.n),
stretches as (select doc_id, q, min(i) as start, count(*) + q as length from pairs group by doc_id, q, island),
runs as (select doc_id, start, length, min(q) as period from stretches where length >= greatest(24, 3 * q) group by doc_id, start, length),
listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by doc_id),
best as (select * from runs
  qualify row_number() over (partition by doc_id order by length::double / period desc, start, period) = 1),
kept as (select w.doc_id, string_agg(w.w, ' ' order by w.i) as text from word w
  where not exists (select 1 from runs r where r.doc_id = w.doc_id and w.i >= r.start + r.period and w.i < r.start + r.length)
  group by w.doc_id)
select t.doc_id, coalesce(l.n_runs, 0) as n_runs, b.start, b.length, b.period, 1000 * b.length // b.period as exponent_milli,
  sha256(coalesce(l.lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from texts t left join listed l using (doc_id) left join best b using (doc_id) left join kept k using (doc_id)
"""

QUERIES = {"op11_periodic_runs": op11_periodic_runs}
CHECKS = {"op11_periodic_runs": _SQL}
