"""Byte-level BPE with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern. First tier: a minimal perfect hash over the vocabulary
(hash and displace) finds the one slot where a pre-token can be; if the bytes there are equal, its rank is the only
token. Second tier, for the others: the bytes form a doubly linked list, and a queue yields the adjacent pair with
the lowest rank, leftmost first, until no pair is in the vocabulary. The queue of a pre-token of more than `_SHORT`
bytes is a heap, so O(n log n) for any length. Shorter ones are merged many at once: links and pairs of each are a row
of arrays, the least of the row is the pair to merge, and each round merges one pair of every row that has one left.

The tables are built once on the driver and broadcast; their size is that of the vocabulary. Tasks remember the ids
of pre-tokens they met, in two generations of at most `REMEMBERED`: a full one replaces the older. A text is one row and never split over tasks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import mix64, shared, table

REMEMBERED = 80_000  # some 160 bytes each, as long ones are not remembered
_ROWS = 200  # texts that are encoded before their rows go on
_LONG = 1 << 18  # texts with more characters are cut into pre-tokens block by block; others share this many
_BLOCK = 50_000  # pre-tokens in a block
_LOAD = 4  # mean keys per displacement bucket
_WHOLE = 32  # pre-tokens longer than this are not remembered
_SHORT = 64  # bytes of a pre-token that is merged as a row
_TOGETHER = 2048  # such rows at once


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line. `path` is a local path or a URI."""
    if "://" in path:
        system, inner = pafs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as stream:
            lines = stream.read().splitlines()
    else:
        with open(path, "rb") as stream:
            lines = stream.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, one displacement per bucket of keys."""

    def __init__(self, keys: Sequence[bytes]):
        n = self.size = len(keys)
        self.buckets = max(1, -(-n // _LOAD))
        hashes = self._hash(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.displacement = np.zeros(self.buckets, np.uint64)
        self.slot_key = np.full(n, -1, np.int64)
        for b in np.argsort(-np.diff(ends), kind="stable"):
            members = order[ends[b] : ends[b + 1]]
            if not len(members):
                break
            self._place(b, members, hashes[members])

    def _place(self, bucket: int, members: np.ndarray, hashes: np.ndarray) -> None:
        """Find the first displacement that sends the bucket's keys to free, different slots."""
        tried = 0
        while True:
            trial = np.arange(tried, tried + 256, dtype=np.uint64)
            slots = self._slots(hashes[None, :], trial[:, None])
            free = (self.slot_key[slots] < 0).all(axis=1)
            for row in np.flatnonzero(free):
                if len(set(slots[row].tolist())) == len(members):
                    self.displacement[bucket] = trial[row]
                    self.slot_key[slots[row]] = members
                    return
            tried += 256

    @staticmethod
    def _hash(keys: Sequence[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))

    def _slots(self, hashes: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        return (mix64(hashes + displacement * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.size)).astype(np.int64)

    def lookup(self, keys: Sequence[bytes]) -> np.ndarray:
        """The only key number each string can have; the caller compares the bytes."""
        hashes = self._hash(keys)
        return self.slot_key[self._slots(hashes, self.displacement[(hashes % np.uint64(self.buckets)).astype(np.int64)])]


class RowMerges:
    """The second tier for many short pre-tokens at once. Tokens are numbered by rank, so the least number goes first."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = sorted(ranks, key=ranks.__getitem__)
        number = {key: i for i, key in enumerate(keys)}
        self.none = len(keys)
        self.ranks = np.array([ranks[key] for key in keys], "<u4")
        self.single = np.array([number[bytes([b])] for b in range(256)])
        pairs = {}  # every cut of a token into two
        for key, i in number.items():
            for cut in range(1, len(key)):
                left, right = number.get(key[:cut]), number.get(key[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = np.array([*sorted(pairs), np.iinfo(np.int64).max])
        self.merged = np.array([*(pairs[p] for p in self.pairs[:-1].tolist()), self.none])

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that two neighbours make, or `none`."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merged[at], self.none)

    def merge(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        # A column more on both sides takes what goes beyond the ends; no token is there, so nothing merges with it.
        width = max(map(len, pieces)) + 2
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join([b"\0" + p.ljust(width - 1, b"\0") for p in pieces]), np.uint8)
        column = np.arange(width)
        inside = ((column > 0) & (column <= lengths[:, None])).ravel()
        ids = np.where(inside, self.single[raw], self.none)
        pair = np.full(len(raw), self.none)
        pair[:-1] = self._pair(ids[:-1], ids[1:])
        after, before = np.arange(1, len(raw) + 1), np.arange(-1, len(raw) - 1)
        queues = pair.reshape(-1, width)
        rows = np.arange(len(pieces))
        while len(rows):
            left = queues[rows].argmin(axis=1) + rows * width
            made = pair[left]
            if not (left_over := made < self.none).all():
                rows, left, made = rows[left_over], left[left_over], made[left_over]
            middle = after[left]
            stop, first = after[middle], before[left]
            ids[left], ids[middle], pair[middle] = made, self.none, self.none
            after[left], before[stop] = stop, left
            pair[left], pair[first] = self._pair(made, ids[stop]), self._pair(ids[first], made)
        kept = ids < self.none
        ends = (4 * np.cumsum(kept.reshape(-1, width).sum(axis=1))).tolist()
        found = self.ranks[ids[kept]].tobytes()
        return [found[begin:end] for begin, end in zip([0, *ends], ends)]


class Codec:
    """Encoder and decoder of one vocabulary. All 256 single bytes must be in it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"vocabulary without the single bytes {missing}")
        self.pattern = pattern
        self.keys = list(ranks)
        self.ranks = np.fromiter(ranks.values(), np.uint32, len(ranks))
        self.hash = PerfectHash(self.keys)
        self.rows = RowMerges(ranks)
        self._prepare()

    def __getstate__(self):
        return self.pattern, self.keys, self.ranks, self.hash, self.rows

    def __setstate__(self, state):
        self.pattern, self.keys, self.ranks, self.hash, self.rows = state
        self._prepare()

    def _prepare(self) -> None:
        self._merges = dict(zip(self.keys, self.ranks.tolist(), strict=True))
        self._by_rank = dict(zip(self.ranks.tolist(), self.keys, strict=True))
        self._pattern = regex.compile(self.pattern)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _merged(self, piece: bytes) -> list[int]:
        """Second tier: merge the lowest-ranked adjacent pair, leftmost first, while there is one."""
        n = len(piece)
        find = self._merges.get
        # A heap entry is one integer: rank, begin and end of the pair, so it orders by rank, then place.
        bits = n.bit_length()
        place = (1 << bits) - 1
        heap = []
        for i in range(n - 1):
            if (rank := find(piece[i : i + 2])) is not None:
                heap.append((rank << bits | i) << bits | i + 2)
        heapify(heap)
        end = list(range(1, n + 2))  # where the part that begins here ends; 0 once it is merged into another
        before = list(range(-1, n))
        while heap:
            entry = heappop(heap)
            stop = entry & place
            left = entry >> bits & place
            middle = end[left]
            # Stale unless both parts are as they were when the pair was found.
            if not 0 < middle < n or end[middle] != stop:
                continue
            end[middle] = 0
            end[left] = stop
            if stop < n:
                before[stop] = left
                if (rank := find(piece[left : end[stop]])) is not None:
                    heappush(heap, (rank << bits | left) << bits | end[stop])
            first = before[left]
            if first >= 0 and (rank := find(piece[first:stop])) is not None:
                heappush(heap, (rank << bits | first) << bits | stop)
        ids, at = [], 0
        while at < n:
            ids.append(self._merges[piece[at : end[at]]])
            at = end[at]
        return ids

    def _resolve(self, pieces: Sequence[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens as little-endian 32-bit integers."""
        raw = [p.encode() for p in pieces]
        found, short = {}, []
        for piece, key, number in zip(pieces, raw, self.hash.lookup(raw).tolist(), strict=True):
            if self.keys[number] == key:
                found[piece] = int(self.ranks[number]).to_bytes(4, "little")
            elif len(key) > _SHORT:
                found[piece] = np.array(self._merged(key), "<u4").tobytes()
            else:
                short.append((key, piece))
        short.sort(key=lambda pair: len(pair[0]))  # rows of much the same length go together
        for at in range(0, len(short), _TOGETHER):
            keys, same = zip(*short[at : at + _TOGETHER], strict=True)
            found.update(zip(same, self.rows.merge(keys), strict=True))
        return found

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a long text in blocks."""
        found = self._pattern.finditer(text)
        while block := [m.group() for m in islice(found, _BLOCK)]:
            yield block

    def _ids(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts cut into pre-tokens; what is new in any of them is resolved at once."""
        known, older = self._known, self._older
        new = {p for pieces in texts for p in pieces if p not in known}
        resolved = {p: older[p] for p in new if p in older}
        if fresh := [p for p in new if p not in resolved]:
            resolved.update(self._resolve(fresh))
        long = {p: resolved.pop(p) for p in new if len(p) > _WHOLE}
        if len(known) + len(resolved) > REMEMBERED:
            self._older = known
            known = self._known = {p: known[p] for pieces in texts for p in pieces if p in known}
        known.update(resolved)
        if long:
            return [b"".join([known[p] if p in known else long[p] for p in pieces]) for pieces in texts]
        return [b"".join([known[p] for p in pieces]) for pieces in texts]

    def encode_batch(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null has none."""
        waiting, held = [], 0
        for text in texts:
            size = len(text or "")
            if held + size > _LONG:
                yield from self._ids(waiting)
                waiting, held = [], 0
            if size > _LONG:
                yield b"".join(ids for block in self._blocks(text) for ids in self._ids([block]))
                continue
            waiting.append(self._pattern.findall(text) if text else [])
            held += size
        yield from self._ids(waiting)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that a sequence of ids (as `encode_batch` gives it) stands for."""
        return b"".join(map(self._by_rank.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def load_codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    return Codec(read_ranks(path), pattern)


def _codec(spark: SparkSession, path: str) -> Broadcast:
    return shared(spark, ("bpe", path), lambda: load_codec(path))


def _mapped(df: DataFrame, text: str, path: str, fields: list[T.StructField], row, keep) -> DataFrame:
    """The columns `keep` of `df`, then what `row(codec, ids of a text)` gives as `fields`, with the vocabulary at `path`."""
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    held = _codec(df.sparkSession, path)
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], *fields])

    def run(batches):
        # What earlier tasks of this worker left in Arrow's pool would stay beside the vocabulary.
        pa.default_memory_pool().release_unused()
        used = held.value
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            values = [row(used, ids) for ids in used.encode_batch(batch.column(len(kept)).to_pylist())]
            columns = [list(c) for c in zip(*values, strict=True)] or [[] for _ in fields]
            made = [pa.array(c, _ARROW[f.dataType]) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*kept, *(f.name for f in fields)])

    return rows.mapInArrow(run, schema)


_IDS = T.ArrayType(T.IntegerType(), False)
_ARROW = {_IDS: pa.list_(pa.field("element", pa.int32(), False)), T.LongType(): pa.int64(), T.StringType(): pa.string()}


def encode(df: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns `keep` of `df` (all, if not given) and `token_ids`, the ids of the whole text.

    No special tokens: their strings are ordinary text. A null or empty text has no ids. A column named
    `token_ids` in `df` is replaced.
    """
    fields = [T.StructField("token_ids", _IDS)]
    return _mapped(df, text, path, fields, lambda _, ids: (np.frombuffer(ids, "<u4").astype(np.int32),), keep)


def decode(df: DataFrame, path: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """`df` and the decoded bytes of each row's ids, in `name` (replaced if there). Null ids give null.

    Bytes, not text: a cut through ids can leave a partial character. An id outside the vocabulary raises.
    """
    held = _codec(df.sparkSession, path)
    kept = [c for c in df.columns if c.lower() != name.lower()]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(ids).alias("__ids"))

    def run(batches):
        codec = held.value
        for batch in batches:
            made = [None if v is None else codec.decode(np.array(v, "<u4").tobytes()) for v in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], [*kept, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField(name, T.BinaryType())]))


def digests(df: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """`n_tokens` and SHA-256 of the ids (little-endian, 32 bits) and of the bytes they decode to.

    The ids and the decoded bytes are made in the task and only their digests leave it.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]

    def row(codec: Codec, ids: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    return _mapped(df, text, path, fields, row, keep)


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), VOCABULARY, keep=["doc_id"])


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
CHECKS: dict[str, str] = {}
