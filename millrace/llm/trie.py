"""The prefix trie of conversations from range minima over sorted common prefixes.

A turn is a digest of role and text. Conversations are sorted by their digests, an end in front of what continues it,
and the common prefix (LCP) of neighbours is found. A prefix belongs to the first conversation that has it; its members
are the rows around it over which the LCP stays at its depth or above. A sparse table of LCP minima finds both ends of
that interval by two binary searches of their own, for all prefixes of a block at once and without a stack or a tree.
All a node tells is a difference of sums over its interval:

* leaves: members, less the neighbours of which one is a prefix of the other;
* children: one, and one for each LCP equal to the depth, less the members that end there;
* saved: code points that neighbours share, less what the parents of the node share between all members.

The sort is by ranges, and a task works on blocks of rows. A node that touches the border of a block leaves it as a piece;
pieces are added up by the 128-bit digest of the prefix. What the last row of a range shares with the first of the next
one is found by joining the prefixes of these two rows.

A row of the sort holds `SEGMENT` turns, so a conversation of any length is many rows, sorted behind the digest of all
before them. Nodes of a segment do not need the ones below, but for leaves and saved code points under groups of
conversations that share whole segments; these are added to one row in each segment above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import mix64, table
from millrace.llm.rangemin import RangeMin
from millrace.llm.runs import SQL_CRC32, SQL_CRC_TABLE
from millrace.operators.joins import join_unique
from millrace.operators.ranges import in_order, running_total_before
from millrace.session import materialize

SEGMENT = 256  # turns in a row of the sort
BLOCK_ROWS = 1 << 15
BLOCK_TURNS = 1 << 18
_DIGEST = 16  # bytes of a turn
_POSITION_BITS = 33  # of monotonically_increasing_id
_NODE, _PIECE, _FIRST, _LAST = range(4)
_TWO64 = 1 << 64


def turn_digests(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, at (from 0), digest (hex) and points (code points of the text) of every turn, in order of `turn`, null first.

    Equal turn numbers are ordered by role, then text. A null role or text is empty. Rows without a conversation take no
    part. Texts go through one shuffle and are not written down.
    """
    spark = df.sparkSession
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
        # Equal rows may be dealt to two ranges.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["conv", "turn", "role", "text", "copy"]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    ordered = (
        rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .select("conv", F.substring(digest, 1, 2 * _DIGEST).alias("digest"), F.length("text").cast("long").alias("points"),
                F.monotonically_increasing_id().alias("row"))
        .select("conv", "digest", "points", F.shiftright("row", _POSITION_BITS).cast("int").alias("chunk"),
                F.col("row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("pos"))
    )
    counted = running_total_before(materialize(ordered, "turns"), ["conv"], F.lit(1).cast("long"), "at")
    return counted.select("conv", F.col("at").cast("long").alias("at"), "digest", "points")


def members_of(turns: DataFrame) -> DataFrame:
    """conv and total (turns) of every conversation."""
    return turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))


def _segments(turns: DataFrame, members: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and segment: conv, seg, keys (digests), points, more (a segment follows)."""
    held = join_unique(turns, members, ["conv"], "inner").select(
        "conv", F.expr(f"at div {segment}").alias("seg"), F.struct("at", "digest", "points").alias("turn"), "total"
    )
    # A conversation without turns has a row as well.
    bare = members.select("conv", F.lit(0).cast("long").alias("seg"), F.lit(None).cast(held.schema["turn"].dataType).alias("turn"), "total")
    rows = held.union(bare).groupBy("conv", "seg").agg(F.array_sort(F.collect_list("turn")).alias("turns"), F.max("total").alias("total"))
    return rows.select(
        "conv",
        "seg",
        F.expr("unhex(array_join(transform(turns, t -> t.digest), ''))").alias("keys"),
        F.expr("transform(turns, t -> t.points)").alias("points"),
        (F.col("total") > (F.col("seg") + 1) * segment).alias("more"),
    )


def _turn_sums(keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers a turn, of its digest and place; their sums name a prefix."""
    salt = (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack((mix64(keys[:, 0] + salt), mix64(keys[:, 1] - salt)), axis=1)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all rows as pairs of 64-bit numbers, and how many each row has."""
    values = column.to_pylist()
    size = np.fromiter(map(len, values), np.int64, len(values)) // _DIGEST
    return np.frombuffer(b"".join(values), "<u8").reshape(-1, 2), size


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each stretch, one stretch behind the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first, size)


def _with_paths(items: DataFrame, segment: int) -> DataFrame:
    """Add path1 and path2, which name all turns in front of the segment."""
    nothing = F.lit(0).cast("long")
    if items.where("more").isEmpty():
        return items.withColumns({"path1": nothing, "path2": nothing})
    long = items.where("more or seg > 0").select("conv", "seg", "keys")

    def sums(batches):
        for batch in batches:
            keys, size = _binary(batch.column("keys"))
            first = batch.column("seg").to_numpy() * segment
            parts = _turn_sums(keys, _spread(first, size))
            total = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(parts, axis=0, dtype=np.uint64)))
            ends = np.cumsum(size)
            both = (total[ends] - total[ends - size]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("seg"), pa.array(both[:, 0]), pa.array(both[:, 1])], ["conv", "seg", "own1", "own2"]
            )

    own = in_order(long.mapInArrow(sums, "conv long, seg long, own1 long, own2 long"), ["conv"], ["seg"])
    kept = own
    for n in ("1", "2"):
        before = running_total_before(own, ["conv"], F.col(f"own{n}").cast("decimal(20,0)"), "before")
        before = before.withColumn("before", F.expr(f"pmod(cast(before as decimal(38,0)), {_TWO64})"))
        wrapped = F.expr(f"case when before >= {_TWO64 // 2} then before - {_TWO64} else before end")
        path = before.select("conv", "seg", wrapped.cast("long").alias(f"path{n}"))
        kept = join_unique(kept, path, ["conv", "seg"], "inner")
    paths = materialize(kept.select("conv", "seg", "path1", "path2"), "paths")
    return join_unique(items, paths, ["conv", "seg"], "left").fillna(0, ["path1", "path2"])


class _Row(NamedTuple):
    """The last row of a block, as the one in front of the next."""

    seg: int
    path: tuple[int, int]
    keys: np.ndarray
    size: int


_OUT = {
    "kind": pa.int32(), "chunk": pa.int64(), "block": pa.int64(), "seg": pa.int64(), "depth": pa.int64(),
    "key1": pa.int64(), "key2": pa.int64(), "up1": pa.int64(), "up2": pa.int64(), "conv": pa.int64(), "up_conv": pa.int64(),
    "n": pa.int64(), "full": pa.int64(), "ended": pa.int64(), "equal": pa.int64(), "shared": pa.int64(), "prefixes": pa.int64(),
    "leaves": pa.int64(), "saved": pa.int64(), "before": pa.int64(), "ends": pa.string(),
}
_OUT_DDL = ", ".join(f"{name} {'string' if kind == pa.string() else 'int' if kind == pa.int32() else 'long'}" for name, kind in _OUT.items())


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


_NO_ENDS = _sha(np.empty(0, np.int64))


class _Block:
    """Sorted rows of one range, behind the row `before` of the block in front (None: the range begins here)."""

    def __init__(self, data: pa.Table, before: _Row | None, chunk: int, number: int, roots: bool, segment: int):
        self.chunk, self.number, self.before, self.segment = chunk, number, before, segment
        self.conv, self.seg = (data.column(c).to_numpy() for c in ("conv", "seg"))
        self.path = np.stack([data.column(c).to_numpy().view(np.uint64) for c in ("path1", "path2")], axis=1)
        self.more = np.array(data.column("more").to_pylist(), bool)
        self.extra = [data.column(c).to_numpy() for c in ("leaves", "saved")]
        self.keys, self.size = _binary(data.column("keys"))
        self.off = np.cumsum(self.size) - self.size
        points = data.column("points").combine_chunks()
        points = (points.chunk(0) if isinstance(points, pa.ChunkedArray) else points).flatten().to_numpy()
        self.points = np.append(0, np.cumsum(points))
        place = _spread(self.seg * segment, self.size)
        self.sums = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(_turn_sums(self.keys, place), axis=0, dtype=np.uint64)))
        # Depth 0 is a node in the first segment only; further down it is a node of the segment above.
        self.floor = np.zeros(len(self.conv), np.int64) if roots else (self.seg > 0).astype(np.int64)

    def last(self) -> _Row:
        n = int(self.size[-1])
        return _Row(int(self.seg[-1]), tuple(self.path[-1].tolist()), self.keys[len(self.keys) - n :].copy(), n)

    def name(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """What names the first `depth` turns of the segment and all in front of it."""
        return self.path[row] + self.sums[self.off[row] + depth] - self.sums[self.off[row]]

    def length(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of the first `depth` turns of the segment."""
        return self.points[self.off[row] + depth] - self.points[self.off[row]]

    def common(self) -> tuple[np.ndarray, int, int]:
        """The LCP of each row with the one before (-1: other group, or none before) and the size of the row before."""
        keys, off, size, seg, path = self.keys, self.off, self.size, self.seg, self.path
        b = self.before
        if b is not None:
            keys, off = np.concatenate((b.keys, keys)), np.append(0, off + b.size)
            size, seg = np.append(b.size, size), np.append(b.seg, seg)
            path = np.concatenate((np.array([b.path], np.uint64), path))
        left, right = np.arange(len(size) - 1), np.arange(1, len(size))
        near = (seg[left] == seg[right]) & (path[left] == path[right]).all(axis=1)
        shorter = np.where(near, np.minimum(size[left], size[right]), 0)
        pair = np.repeat(left, shorter)
        step = _spread(np.zeros(len(left), np.int64), shorter)
        differ = np.flatnonzero((keys[off[pair] + step] != keys[off[pair + 1] + step]).any(axis=1))
        lcp = shorter.copy()
        lcp[pair[differ][::-1]] = step[differ][::-1]
        lcp[~near] = -1
        return (lcp, True, b.size) if b is not None else (np.append(-1, lcp), False, 0)

    def nodes(self) -> pa.RecordBatch:
        n = len(self.conv)
        lcp, behind, size_before = self.common()
        low = np.maximum(lcp + 1, self.floor)
        count = np.maximum(self.size - low + 1, 0)
        row, depth = np.repeat(np.arange(n), count), _spread(low, count)
        # Prefixes of the first row that the row before has as well go on here.
        old = np.arange(self.floor[0], lcp[0] + 1)
        row, depth = np.append(np.zeros(len(old), np.int64), row), np.append(old, depth)
        goes_on = np.arange(len(row)) < len(old)

        inside = lcp.copy()
        inside[0] = -1
        minima, smallest = RangeMin(inside), RangeMin(self.conv)
        left, right = minima.left(row, depth), minima.right(row, depth)
        open_left = goes_on | ((left == 0) & (not behind))
        border = open_left | (right == n - 1)

        def within(values: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
            """How many of `at` in first..right have the value `depth`."""
            place = np.sort(values[at] * n + at)
            return np.searchsorted(place, depth * n + right, "right") - np.searchsorted(place, depth * n + first, "left")

        def summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values))
            return total[right + 1] - total[first]

        every = np.arange(n)
        full = within(self.size, every, left)
        ended = within(self.size, every[~self.more], left)
        near = np.flatnonzero(inside >= 0)
        first = np.where(goes_on, left, left + 1)
        shared = np.where(lcp >= 0, self.length(every, np.maximum(lcp, 0)), 0)
        is_prefix = (lcp >= 0) & (lcp == np.append(size_before, self.size[:-1]))
        equal = within(inside, near, left + 1) + (goes_on & (lcp[0] == depth))
        members = right - left + 1
        leaves, saved = (summed(e, left) for e in self.extra)
        shared, prefixes = summed(shared, first), summed(is_prefix.astype(np.int64), first)
        before = np.where(depth > 0, self.length(row, np.maximum(depth - 1, 0)), 0)
        border |= full > ended  # children are in the next segment

        up = np.maximum(depth - 1, 0)
        up_left, up_right = minima.left(row, up), minima.right(row, up)
        up_open = ((up_left == 0) & ((not behind) | (up <= lcp[0]))) | (up_right == n - 1)
        up_open |= (depth == 1) & (self.seg[row] > 0)
        up_conv = smallest.least(up_left, up_right)
        conv = smallest.least(left, right)
        top = (self.seg[row] == 0) & (depth == 0)
        unknown = up_open | top

        ends: list[str | None] = [_NO_ENDS] * len(row)
        for k in np.flatnonzero(ended | border).tolist():
            ids = self.conv[left[k] : left[k] + ended[k]]
            ends[k] = (",".join(map(str, ids.tolist())) if ended[k] else None) if border[k] else _sha(ids)
        name, above = self.name(row, depth).view(np.int64), self.name(row, up).view(np.int64)
        made = {
            "kind": np.where(border, _PIECE, _NODE).astype(np.int32), "chunk": np.full(len(row), self.chunk),
            "block": np.full(len(row), self.number), "seg": self.seg[row], "depth": depth + self.seg[row] * self.segment,
            "key1": name[:, 0], "key2": name[:, 1], "up1": above[:, 0], "up2": above[:, 1], "conv": conv,
            "up_conv": pa.array(up_conv, pa.int64(), mask=unknown),
            "n": members, "full": full, "ended": ended, "equal": equal, "shared": shared, "prefixes": prefixes,
            "leaves": leaves, "saved": saved, "before": before, "ends": pa.array(ends, pa.string()),
        }
        return pa.RecordBatch.from_pydict({c: pa.array(v, _OUT[c]) if isinstance(v, np.ndarray) else v for c, v in made.items()}, schema=pa.schema(_OUT))

    def prefixes(self, row: int, kind: int) -> pa.RecordBatch:
        """All prefixes of a row at the border of a range: key, depth, and code points or (last row) the row's depth."""
        depth = np.arange(self.floor[row], self.size[row] + 1)
        at = np.full(len(depth), row)
        name = self.name(at, depth).view(np.int64)
        base = int(self.seg[row]) * self.segment
        told = {"kind": np.full(len(depth), kind, np.int32), "chunk": np.full(len(depth), self.chunk), "seg": np.full(len(depth), self.seg[row]),
                "depth": depth + base, "key1": name[:, 0], "key2": name[:, 1],
                "shared": self.length(at, depth) if kind == _FIRST else np.full(len(depth), base + self.size[row])}
        return pa.RecordBatch.from_pydict(
            {c: pa.array(told[c], t) if c in told else pa.nulls(len(depth), t) for c, t in _OUT.items()}, schema=pa.schema(_OUT)
        )


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.Table]:
    held, rows, turns = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, block_rows):
            part = batch.slice(start, block_rows)
            held.append(part)
            rows += part.num_rows
            turns += len(part.column("points").flatten())
            if rows >= block_rows or turns >= BLOCK_TURNS:
                yield pa.Table.from_batches(held)
                held, rows, turns = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _scan(items: DataFrame, roots: bool, segment: int, block_rows: int) -> DataFrame:
    """Nodes, pieces of nodes at borders, and the prefixes of the first and last row of each range."""
    order = ["seg", "path1", "path2", "keys", "more", "conv"]
    ranges = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = items.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def run(batches):
        chunk, block, before = TaskContext.get().partitionId(), None, None
        for number, data in enumerate(_blocks((b for b in batches if b.num_rows), block_rows)):
            block = _Block(data, before, chunk, number, roots, segment)
            before = block.last()
            if not number:
                yield block.prefixes(0, _FIRST)
            yield block.nodes()
        if block is not None:
            yield block.prefixes(len(block.conv) - 1, _LAST)

    return materialize(rows.mapInArrow(run, _OUT_DDL), "trie")


_SUMS = ("n", "full", "ended", "equal", "shared", "prefixes", "leaves", "saved")


_KEY = ["key1", "key2", "seg", "depth"]
_ENDS_DDL = "key1 long, key2 long, seg long, depth long, ends string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the ids of each key, which come in order, some at a time."""
    key, digest, done = None, None, []
    for batch in batches:
        for *here, ends in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ends")), strict=True):
            if here == key:
                digest.update(b"," + ends.encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = here, hashlib.sha256(ends.encode())
        yield pa.RecordBatch.from_pylist([dict(zip((*_KEY, "ends"), row, strict=True)) for row in done], schema=_ENDS)
        done = []
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip((*_KEY, "ends"), (*key, digest.hexdigest()), strict=True))], schema=_ENDS)


_ENDS = pa.schema([(c, pa.int64()) for c in _KEY] + [("ends", pa.string())])


def _added_up(pieces: DataFrame) -> DataFrame:
    """One row per key. Numbers are added up before the shuffle; only ids that end at a node are brought in order."""
    one = [F.min("conv").alias("conv"), F.min("up_conv").alias("up_conv"), *(F.max(c).alias(c) for c in ("before", "up1", "up2"))]
    sums = pieces.groupBy(*_KEY).agg(*(F.sum(c).alias(c) for c in _SUMS), *one)
    ends = pieces.where("ends is not null").select(*_KEY, "chunk", "block", "ends")
    ends = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk", "block").mapInArrow(_hashed, _ENDS_DDL)
    return join_unique(sums, ends, _KEY, "left").withColumns({"kind": F.lit(_PIECE), "ends": F.coalesce("ends", F.lit(_NO_ENDS))})


def _pieces(scanned: DataFrame) -> DataFrame:
    """Pieces of nodes at borders, and what the pairs of rows over borders of ranges add to them."""
    first, last = (scanned.where(F.col("kind") == kind) for kind in (_FIRST, _LAST))
    # One row per range: the window without a key sees no more.
    ranges = first.select("chunk").distinct().select("chunk", F.lag("chunk").over(W.orderBy("chunk")).alias("prior"))
    first = first.join(F.broadcast(ranges), "chunk")
    met = first.select("chunk", "prior", *_KEY, "shared").join(
        last.select(F.col("chunk").alias("prior"), *_KEY, F.col("shared").alias("total")), ["prior", *_KEY]
    )
    deepest = met.groupBy("chunk").agg(F.max("depth").alias("lcp"), F.max_by("shared", "depth").alias("common"))
    met = met.join(deepest, "chunk")
    zero = F.lit(0).cast("long")
    told = {
        "kind": F.lit(_PIECE), "block": F.lit(-1).cast("long"), **{c: zero for c in _SUMS},
        "shared": F.col("common"), "equal": (F.col("lcp") == F.col("depth")).cast("long"),
        "prefixes": (F.col("lcp") == F.col("total")).cast("long"),
    }
    over = met.select(*[
        told[f.name].alias(f.name) if f.name in told else F.col(f.name) if f.name in ("chunk", *_KEY) else F.lit(None).cast(f.dataType).alias(f.name)
        for f in scanned.schema.fields
    ])
    return scanned.where(F.col("kind") == _PIECE).union(over)


def _nodes(items: DataFrame, roots: bool, segment: int, block_rows: int) -> DataFrame:
    """One row per prefix of a segment, with what its interval adds up to; `kind` is 1 for those that were in pieces."""
    scanned = _scan(items, roots, segment, block_rows)
    whole = materialize(_added_up(_pieces(scanned)), "pieces")
    columns = ["kind", *_KEY, "up1", "up2", "conv", "up_conv", *_SUMS, "before", "ends"]
    rows = scanned.where(F.col("kind") == _NODE).select(*columns).union(whole.select(*columns))
    return rows.withColumns({
        "leaves": F.col("n") - F.col("prefixes") + F.col("leaves"),
        "saved": F.col("shared") - (F.col("n") - 1) * F.col("before") + F.col("saved"),
        "children": F.col("equal") + 1 - F.col("full"),
    })


def trie(turns: DataFrame, members: DataFrame, segment: int = SEGMENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The trie of conversations given as `turn_digests` gives them, and as conv and total (turns) of every one.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every distinct prefix, the empty one included. Without members there are no nodes. `segment` and
    `block_rows` bound what a task holds and change no row.
    """
    items = materialize(_with_paths(materialize(_segments(turns, members, segment), "segments"), segment), "rows")
    nothing = F.lit(0).cast("long")
    plain = items.withColumns({"leaves": nothing, "saved": nothing})
    below = plain.where("seg > 0")
    deep = not below.isEmpty()
    if deep:
        groups = _nodes(below, True, segment, block_rows).where((F.col("depth") == F.col("seg") * segment) & (F.col("n") > 1))
        above = groups.select("conv", F.explode(F.expr("sequence(cast(0 as bigint), seg - 1)")).alias("seg"),
                              (F.col("leaves") - 1).alias("leaves"), "saved")
        above = above.groupBy("conv", "seg").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        plain = join_unique(items, above, ["conv", "seg"], "left").fillna(0, ["leaves", "saved"]).select(*plain.columns)
    nodes = _nodes(plain, False, segment, block_rows)
    if deep:
        nodes = materialize(nodes, "nodes")
        lower = nodes.where((F.col("seg") > 0) & (F.col("depth") == F.col("seg") * segment + 1))
        lower = lower.groupBy(F.col("up1").alias("key1"), F.col("up2").alias("key2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("more"))
        nodes = join_unique(nodes, lower, ["key1", "key2", "depth"], "left").withColumn("children", F.col("children") + F.coalesce("more", nothing))
    parents = nodes.where(F.col("kind") == _PIECE).select(
        F.col("key1").alias("up1"), F.col("key2").alias("up2"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("joined")
    )
    out = [F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
           F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
           F.col("ends").alias("ends_sha256")]
    known = (F.col("depth") == 0) | F.col("up_conv").isNotNull()
    rest = join_unique(nodes.where(~known), parents, ["up1", "up2", "depth"], "left").withColumn("up_conv", F.col("joined"))
    return nodes.where(known).withColumn("up_conv", F.when(F.col("depth") > 0, F.col("up_conv"))).select(*out).union(rest.select(*out))


def conversation_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of the conversations in `df`, one row per node; see `trie` and `turn_digests`.

    Repeated rows are repeated turns. Extra columns are not read.
    """
    turns = materialize(turn_digests(df, conv, turn, role, text), "digests")
    return trie(turns, materialize(members_of(turns), "members"))


MOST_OPENING = 5  # turns that a conversation of the query takes from another one


def shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members of conversations c that open with the first crc32(c) % 6 turns of conversation c - c % 100.

    Their own turns follow behind as many of their own.
    """
    opens = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % (MOST_OPENING + 1)
    base = F.col("conv") - F.col("conv") % 100
    opening = (
        turns.where((F.col("conv") % 100 == 0) & (F.col("at") < MOST_OPENING))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "points"))).alias("opening"))
    )
    each = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns({"base": base, "h": opens.cast("int")})
    each = join_unique(each, opening, ["base"], "left")
    each = each.withColumn("opening", F.expr("slice(coalesce(opening, cast(array() as array<struct<at:bigint,digest:string,points:bigint>>)), 1, h)"))
    each = each.withColumn("taken", F.size("opening").cast("long"))
    each = materialize(each.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "openings")
    head = each.select("conv", F.explode("opening").alias("turn")).select("conv", "turn.at", "turn.digest", "turn.points")
    own = join_unique(turns, each.select("conv", "h", "taken"), ["conv"], "inner").where("at >= h")
    own = own.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "points")
    return head.union(own), each.select("conv", "total")


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = materialize(turn_digests(table(spark, folder, "conversations")), "digests")
    return trie(*shared_openings(turns))


_SQL = f"""
with {SQL_CRC_TABLE},
turns as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (partition by conv_id
  order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos from conversations where conv_id is not null),
ids as (select distinct c from turns),
convs as (select c, {SQL_CRC32.format("c")} % 6 as h, c - c % 100 as base from ids, crc_list),
heads as (select v.c, t.pos, t.r, t.x from convs v join turns t on t.c = v.base and t.pos < v.h),
taken as (select c, count(*) as n from heads group by c),
rebuilt as (select * from heads union all
  select t.c, t.pos - h + coalesce(n, 0), r, x from turns t join convs using (c) left join taken using (c) where t.pos >= h),
sizes as (select c, count(r) as total from ids left join rebuilt using (c) group by c),
prefixes as (
  select c, pos + 1 as d, length(x) as points, sha256(string_agg(length(r) || ':' || r || length(x) || ':' || x, '')
    over (partition by c order by pos)) as p from rebuilt
  union all select c, 0, 0, '' from ids),
nodes as (select p, d, min(c) as conv_id, count(*) as n, any_value(points) as points from prefixes group by p, d),
up as (select n.p, n.d, m.p as up, m.conv_id as parent from nodes n join prefixes f on f.c = n.conv_id and f.d = n.d - 1
  join nodes m on m.p = f.p and m.d = f.d),
children as (select up as p, count(*) as children from up group by up),
below as (select f.p, f.d, sum((n.n - 1) * n.points) as saved, count(*) filter (where c.children is null) as leaves
  from nodes n left join children c using (p) join prefixes f on f.c = n.conv_id and f.d <= n.d group by f.p, f.d),
ends as (select p, d, string_agg(c::varchar, ',' order by c) as ids from prefixes join sizes using (c) where d = total group by p, d)
select n.conv_id, n.d::bigint as depth, up.parent as parent_conv_id, n.n as n_convs, coalesce(c.children, 0) as n_children,
  b.leaves as n_leaves, b.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n left join up on up.p = n.p and up.d = n.d left join children c on c.p = n.p
join below b on b.p = n.p and b.d = n.d left join ends e on e.p = n.p and e.d = n.d
"""

QUERIES = {"op13_conversation_trie": op13_conversation_trie}
CHECKS = {"op13_conversation_trie": _SQL}
