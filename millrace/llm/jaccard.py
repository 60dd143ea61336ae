"""Join of texts by the Jaccard similarity of their word n-grams, with filters under several global token orders.

Sets of equal shingles are one class. Two sets with similarity s share a token among their first
n - ceil(s n) + 1 tokens under any order of all tokens, and at the first one that they share enough tokens must
follow on both sides (position filter). Every order here puts tokens first that occur in a single set:

1. Tokens are dealt by hash; each task counts in how many sets its tokens occur. Tokens of one set can match
   nothing, and a set where these leave fewer than ceil(s n) tokens has no partner. Only the other sets go on.
   Hot tokens, found beforehand by frequency summaries of all tasks, are not dealt by hash but with their sets: any
   other token has at most half of what a task holds on average.
2. Rounds of leaders: under the first order, each set is compared with the drawn leaders of the token blocks that it
   meets most often. Found links form components, so a large group of near copies needs no pair inside it.
3. The first step is repeated with components in place of sets: tokens that occur in one component only cannot
   link it to another. Candidates are pairs of different components that share a prefix token under the first order
   and pass position and bitmap filter; those that also pass under each other order are verified. The orders differ
   in how finely they rank by frequency and in their hash.

No link between different components is lost, so the components are exact. Tokens are 64-bit hashes, compared by
their partition and 40 more bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import mix64, table, text_chunks
from millrace.operators.joins import join_unique
from millrace.session import materialize

WORDS = 5
# Similarity as a fraction of integers, so that the threshold is exact.
SHARED, OF = 75, 100
ORDERS = 3
LEADER_ROUNDS = 1
# Entries of a frequency summary, and so at most as many hot tokens, per part that tokens are dealt to.
ROOM = 4
DRAWS = 8
BITS = 512
_CHUNK = 1 << 19
_TOKEN_BYTES = 5
_LOW = np.uint64((1 << 8 * _TOKEN_BYTES) - 1)
_U = np.uint64

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n at least; kept, and grown by need."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, _CHUNK * 2), base, _U)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, one text after the other; and where each text ends.

    A-Z count as a-z; words are runs of bytes other than ASCII white space. A text with fewer words than a shingle
    has its whole sequence as the only one; null and texts without a word have none.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"".join(r.lower() + b"\n" for r in raw), np.uint8)
    text_end = np.cumsum([len(r) + 1 for r in raw])
    gap = _SEPARATOR[data]
    begins = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    ends = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    # A word's hash is a sum of byte values times powers of a base, shifted back to the word's begin.
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[data] * _power_table(_BASE, len(data)))))
    word = mix64((sums[ends] - sums[begins]) * _power_table(_INVERSE, len(data) + 1)[begins])
    owner = np.searchsorted(text_end, begins, side="right")
    place = mix64(np.arange(1, words + 1, dtype=_U)) | _U(1)

    n = max(0, len(word) - words + 1)
    shingle = np.zeros(n, _U)
    for k in range(words):
        shingle += word[k : k + n] * place[k]
    inside = owner[:n] == owner[words - 1 :] if n else np.zeros(0, bool)
    shingle, of = mix64(shingle[inside]), owner[:n][inside]
    count = np.bincount(owner, minlength=len(texts))
    for i in np.flatnonzero((count > 0) & (count < words)):
        own = word[np.searchsorted(owner, i) :][: count[i]]
        short = mix64(np.array([(own * place[: len(own)]).sum() + _U(len(own))], _U))
        at = np.searchsorted(of, i)
        shingle, of = np.insert(shingle, at, short), np.insert(of, at, i)
    stop = np.searchsorted(of, np.arange(len(texts)), side="right")
    for a, b in zip([0, *stop[:-1]], stop, strict=True):
        shingle[a:b].sort()
    fresh = np.ones(len(shingle), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])
    return shingle[fresh], np.cumsum(np.bincount(of[fresh], minlength=len(texts)))


def _names(sets: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 128-bit name of each set, as two 64-bit integers."""
    raw = b"".join(xxhash.xxh3_128_digest(sets[a:b].tobytes()) for a, b in zip([0, *stop[:-1]], stop, strict=True))
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


class _Summary:
    """Misra-Gries counts of tokens: at most `room`, each too small by at most the number of all over `room`."""

    def __init__(self, room: int):
        self.room, self.total = room, 0
        self.tokens, self.times = np.zeros(0, _U), np.zeros(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        self.total += len(tokens)
        fresh, times = np.unique(tokens, return_counts=True)
        every, at = np.unique(np.concatenate((self.tokens, fresh)), return_inverse=True)
        sums = np.zeros(len(every), np.int64)
        np.add.at(sums, at, np.concatenate((self.times, times)))
        if len(every) > self.room:
            sums -= np.partition(sums, -self.room - 1)[-self.room - 1]
        self.tokens, self.times = every[sums > 0], sums[sums > 0]


def classes_of(df: DataFrame, key: str, text: str, words: int, keep: Sequence[str] = (), room: int = 0) -> DataFrame:
    """(key, n_shingles, hi, lo): rows with equal sets have equal (hi, lo). A row without shingles is named by its key.

    The columns `keep` of `df` follow as c0, c1 and so on. With `room`, columns `token` and `times` follow instead:
    null in the rows so far, and filled in further rows with a frequency summary of each task's different sets; there
    a null token has the number of all.
    """
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), *kept)
    long = T.LongType()
    added = [T.StructField(c, long) for c in ("n_shingles", "hi", "lo")]
    more = [T.StructField(c, long) for c in ("token", "times")] if room else rows.schema.fields[2:]
    schema = T.StructType([rows.schema.fields[0], *added, *more])

    def run(batches):
        met, summary = set(), _Summary(room)
        for batch in batches:
            for start, texts in text_chunks(batch.column(1), _CHUNK):
                sets, stop = shingle_sets(texts, words)
                name = _names(sets, stop)
                cut = batch.slice(start, len(texts)).columns
                size = np.diff(stop, prepend=0)
                made = [cut[0], *map(pa.array, (size, name[:, 0], name[:, 1])), *cut[2:]]
                if room:
                    summary.add(sets[np.repeat(_unmet(name, met), size)])
                    made += [pa.nulls(len(texts), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(made, schema.names)
        if summary.total:
            n = len(summary.tokens) + 1
            told = [pa.array([None, *summary.tokens.view(np.int64).tolist()], pa.int64()),
                    pa.array([summary.total, *summary.times.tolist()], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64())] * 4 + told, schema.names)

    empty = F.col("n_shingles") == 0
    return rows.mapInArrow(run, schema).select(
        "key",
        "n_shingles",
        F.when(empty, F.coalesce("key", F.lit(-1))).otherwise(F.col("hi")).alias("hi"),
        F.when(empty, F.lit(0)).otherwise(F.col("lo")).alias("lo"),
        *[f.name for f in more],
    )


def _unmet(names: np.ndarray, met: set) -> np.ndarray:
    """Which of the names are not in `met`; they are put there."""
    new = np.zeros(len(names), bool)
    for i, pair in enumerate(map(tuple, names.tolist())):
        if pair not in met:
            met.add(pair)
            new[i] = True
    return new


@dataclass
class Hot:
    """Keys of hot tokens, sorted, and their frequency classes. Tokens that are not `live` can match nothing."""

    keys: np.ndarray
    classes: np.ndarray
    live: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key that is hot, else -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1).astype(np.int32)


def _parts(spark: SparkSession) -> int:
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 20)


def _class_of(times: np.ndarray) -> np.ndarray:
    return np.minimum(255, 8 * np.log2(np.maximum(times, 1))).astype(np.uint8)


def _key_of(tokens: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part that each token is dealt to, and its key: that part and the low bytes of its hash."""
    part = ((tokens >> _U(40)) * _U(parts)) >> _U(24)
    return part.astype(np.int32), (tokens & _LOW) | (part << _U(8 * _TOKEN_BYTES))


def _classes_and_hot(df: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, Hot]:
    """The classes of `df`, as a table, and the tokens that have more than a fair share of all occurrences.

    Summaries of `room` entries miss at most a `room`-th of all occurrences of a token. Tokens with a `room`-th left are
    hot, at most `room` of them; each other one has less than two `room`-ths, half of a part.
    """
    parts = _parts(df.sparkSession)
    room = ROOM * parts
    rows = materialize(classes_of(df, key, text, words, room=room), "classes")
    told = rows.where(F.col("times").isNotNull())
    total = told.where(F.col("token").isNull()).agg(F.sum("times")).first()[0] or 0
    sums = told.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("times").alias("times"))
    found = sums.where(F.col("times") * room >= total).collect() if total else []
    keys = _key_of(np.array([r["token"] for r in found], np.int64).view(_U), parts)[1]
    order = np.lexsort((-np.array([r["times"] for r in found], np.int64), keys))
    order = order[_runs(keys[order])] if len(order) else order
    classes = _class_of(np.array([r["times"] for r in found], np.int64))
    base = rows.where(F.col("times").isNull()).drop("token", "times")
    return base, Hot(keys[order], classes[order], np.ones(len(order), bool))


# A class in a packed row: its name, its number of shingles, and how many of the row's tokens are its own.
_OWNER = np.dtype([("hi", "<i8"), ("lo", "<i8"), ("n", "<i4"), ("count", "<i4")])
# Tokens are low bytes of hashes, dealt to their part; hot ones are numbers in the list, dealt to the bucket of their set.
_PACKED = "part int, hot boolean, owners binary, tokens binary"
_HOT_BYTES = 4


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = False
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


def _packed_rows(part: np.ndarray, owner: np.ndarray, names: np.ndarray, tokens: np.ndarray, hot: bool = False) -> pa.RecordBatch:
    """One row per part, from tokens that are sorted by part and owner. `names` has an _OWNER for each owner."""
    begin = _runs(part, owner)
    owners = names[owner[begin]]
    owners["count"] = np.diff(np.append(begin, len(part)))
    cut = np.append(_runs(part[begin]), len(begin)) if len(begin) else np.zeros(1, np.int64)
    edge = np.append(begin, len(part))
    rows = list(zip(cut[:-1], cut[1:], strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([part[begin[a]] for a, _ in rows], pa.int32()),
         pa.array([hot] * len(rows), pa.bool_()),
         pa.array([owners[a:b].tobytes() for a, b in rows], pa.binary()),
         pa.array([tokens[edge[a] : edge[b]].tobytes() for a, b in rows], pa.binary())],
        ["part", "hot", "owners", "tokens"],
    )


def _dealt_rows(key: np.ndarray, part: np.ndarray, owner: np.ndarray, names: np.ndarray, parts: int, hot: Hot):
    """Tokens of sets, in the order of their owners, as packed rows: one batch of hot ones, one of the others."""
    number = hot.find(key)
    cold = number < 0
    if cold.any():
        order = np.flatnonzero(cold)[np.argsort(part[cold], kind="stable")]
        low = key[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TOKEN_BYTES]
        yield _packed_rows(part[order], owner[order], names, low)
    live = np.flatnonzero(~cold)
    live = live[hot.live[number[live]]]
    if len(live):
        bucket = _bucket(names[owner[live]], parts)
        order = np.argsort(bucket, kind="stable")
        raw = number[live][order].astype("<i4").view(np.uint8).reshape(-1, _HOT_BYTES)
        yield _packed_rows(bucket[order], owner[live][order], names, raw, hot=True)


def _bucket(owners: np.ndarray, buckets: int) -> np.ndarray:
    return (owners["hi"].astype(_U) % _U(buckets)).astype(np.int32)


def _unpacked(held: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of packed rows: the part of each owner, the owners, and the tokens as bytes of `width`."""
    parts, owners, tokens = [], [], []
    for batch in held:
        for part, own, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "owners", "tokens")), strict=True):
            owners.append(np.frombuffer(own, _OWNER))
            parts.append(np.full(len(owners[-1]), part, np.int64))
            tokens.append(np.frombuffer(raw, np.uint8))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, _OWNER), np.zeros((0, width), np.uint8)
    return np.concatenate(parts), np.concatenate(owners), np.concatenate(tokens).reshape(-1, width)


def _once(part: np.ndarray, owners: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens without those of owners that are in the part before, and the number of each one's owner."""
    order = np.lexsort((owners["lo"], owners["hi"], part))
    copy = np.ones(len(order), bool)
    copy[order[_runs(part[order], owners["hi"][order], owners["lo"][order])]] = False
    of = np.repeat(np.arange(len(owners)), owners["count"])
    return (data[~copy[of]], of[~copy[of]]) if copy.any() else (data, of)


def _token_keys(data: np.ndarray, part: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :_TOKEN_BYTES] = data[:, :_TOKEN_BYTES]
    return wide.view("<u8").ravel() | (part.astype(_U) << _U(8 * _TOKEN_BYTES))


def _dealt(df: DataFrame, text: str, words: int, parts: int, hot: Broadcast) -> DataFrame:
    """The tokens of a chunk of texts, one row per part. A task deals a class once, so copies are mostly dropped here."""

    def run(batches):
        met = set()
        for batch in batches:
            for _, texts in text_chunks(batch.column(0), _CHUNK):
                sets, stop = shingle_sets(texts, words)
                names = np.zeros(len(texts), _OWNER)
                name = _names(sets, stop)
                names["hi"], names["lo"], names["n"] = name[:, 0], name[:, 1], np.diff(stop, prepend=0)
                new = (names["n"] > 0) & _unmet(name, met)
                owner = np.repeat(np.arange(len(texts)), names["n"])
                sets, owner = sets[new[owner]], owner[new[owner]]
                part, key = _key_of(sets, parts)
                yield from _dealt_rows(key, part, owner, names, parts, hot.value)

    return df.select(F.col(text).alias("text")).mapInArrow(run, _PACKED)


def _counted(buckets: int, by_component: bool):
    """Of all rows of a part: the tokens that occur in several sets, or in several components, by bucket of sets.

    A packed token is its 5 bytes and one byte that grows with the logarithm of its frequency.
    """

    def run(batches):
        held = [b for b in batches if b.num_rows]
        part, owners, data = _unpacked([b.filter(b.column(1)) for b in held], _HOT_BYTES)
        if len(data):
            data, of = _once(part, owners, data)
            order = np.argsort(part[of], kind="stable")
            rows = _packed_rows(part[of][order].astype(np.int32), of[order], owners, data[order], hot=True)
            yield _of_part(rows, -1)
        part, owners, data = _unpacked([b.filter(pc.invert(b.column(1))) for b in held], _TOKEN_BYTES)
        del held
        if not len(data):
            return
        data, of = _once(part, owners, data)
        token = _token_keys(data, part[of])
        order = np.lexsort((owners["lo"][of], token)) if by_component else np.argsort(token)
        border = np.append(_runs(token[order]), len(order))
        # How often each token occurs: rows of its run, or the components that begin in it.
        times = np.diff(border)
        if by_component:
            begins = np.zeros(len(order) + 1, np.int64)
            begins[_runs(token[order], owners["lo"][of][order]) + 1] = 1
            times = np.diff(np.cumsum(begins)[border])
        frequency = np.empty(len(token), np.int64)
        frequency[order] = np.repeat(times, np.diff(border))
        shared = frequency > 1
        data, of, frequency = data[shared], of[shared], frequency[shared]
        packed = np.empty((len(data), _TOKEN_BYTES + 1), np.uint8)
        packed[:, :_TOKEN_BYTES] = data
        packed[:, _TOKEN_BYTES] = _class_of(frequency)
        bucket = _bucket(owners, buckets)
        for own in np.unique(part[of]):
            chosen = np.flatnonzero(part[of] == own)
            chosen = chosen[np.argsort(bucket[of[chosen]], kind="stable")]
            yield _of_part(_packed_rows(bucket[of[chosen]], of[chosen], owners, packed[chosen]), own)

    return run


def _of_part(rows: pa.RecordBatch, part: int) -> pa.RecordBatch:
    """Packed rows by bucket, with the part that their tokens are from; -1 for hot ones."""
    columns = [rows.column(0), pa.array(np.full(rows.num_rows, part, np.int32)), *rows.columns[2:]]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "part", "owners", "tokens"])


def _joined(hot: Broadcast):
    """One row per set of the bucket that can have a partner: its shared tokens, sorted, and their frequency classes."""

    def run(batches):
        held = [b.select(["part", "owners", "tokens"]) for b in batches if b.num_rows]
        if not held:
            return
        is_hot = [pc.equal(b.column(0), -1) for b in held]
        part, owners, data = _unpacked([b.filter(pc.invert(h)) for b, h in zip(held, is_hot, strict=True)], _TOKEN_BYTES + 1)
        _, hot_owners, numbers = _unpacked([b.filter(h) for b, h in zip(held, is_hot, strict=True)], _HOT_BYTES)
        del held
        of = np.repeat(np.arange(len(owners)), owners["count"])
        token, kind = _token_keys(data, part[of]), data[:, _TOKEN_BYTES]
        numbers = np.ascontiguousarray(numbers).view("<i4").ravel()
        of = np.concatenate((of, np.repeat(np.arange(len(hot_owners)) + len(owners), hot_owners["count"])))
        owners = np.concatenate((owners, hot_owners))
        token = np.concatenate((token, hot.value.keys[numbers]))
        kind = np.concatenate((kind, hot.value.classes[numbers]))
        order = np.lexsort((owners["lo"], owners["hi"]))
        begin = _runs(owners["hi"][order], owners["lo"][order])
        number = np.empty(len(owners), np.int64)
        number[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        names = owners[order[begin]]
        shared = np.bincount(number[of], minlength=len(names))
        order = np.lexsort((token, number[of]))
        token, kind = token[order], kind[order]
        edge = np.concatenate(([0], np.cumsum(shared)))
        able = np.flatnonzero(shared * OF >= names["n"].astype(np.int64) * SHARED)
        for a in range(0, len(able), 500):
            own = able[a : a + 500]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names["hi"][own]), pa.array(names["lo"][own]), pa.array(names["n"][own]),
                 pa.array([token[edge[i] : edge[i + 1]].tobytes() for i in own], pa.binary()),
                 pa.array([kind[edge[i] : edge[i + 1]].tobytes() for i in own], pa.binary())],
                ["hi", "lo", "n", "tokens", "classes"],
            )

    return run


def _able(dealt: DataFrame, parts: int, by_component: bool, hot: Broadcast) -> DataFrame:
    """The sets (hi, lo, n, tokens, classes) with enough tokens in common with other sets, or other components."""
    dealt = dealt.repartitionById(parts, F.col("part"))
    shared = dealt.mapInArrow(_counted(parts, by_component), "bucket int, part int, owners binary, tokens binary")
    shared = shared.repartitionById(parts, F.col("bucket"))
    return shared.mapInArrow(_joined(hot), "hi long, lo long, n int, tokens binary, classes binary")


def _several_components(sets: DataFrame, labels: DataFrame, hot: Hot) -> Hot:
    """The hot tokens; live are those that occur in several components."""
    if not len(hot.keys):
        return hot
    held = sets.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        low = np.full(len(held.value.keys), np.iinfo(np.int64).max)
        high = np.full(len(low), -1)
        for batch in batches:
            raw = [np.frombuffer(t, "<u8") for t in batch.column(1).to_pylist()]
            comp = np.repeat(batch.column(0).to_numpy(), [len(t) for t in raw])
            number = held.value.find(np.concatenate(raw)) if raw else np.zeros(0, np.int32)
            np.minimum.at(low, number[number >= 0], comp[number >= 0])
            np.maximum.at(high, number[number >= 0], comp[number >= 0])
        met = np.flatnonzero(high >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(low[met]), pa.array(high[met])], ["number", "low", "high"])

    ends = _labelled(sets.select("id", "tokens"), labels).select("comp", "tokens").mapInArrow(run, "number long, low long, high long")
    ends = ends.groupBy("number").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    live = np.zeros(len(hot.keys), bool)
    live[[r["number"] for r in ends.where(F.col("low") < F.col("high")).collect()]] = True
    return Hot(hot.keys, hot.classes, live)


def _dealt_again(sets: DataFrame, labels: DataFrame, parts: int, hot: Broadcast) -> DataFrame:
    """The tokens of sets, dealt as at first; a set is named by its id and component."""

    def run(batches):
        for batch in batches:
            raw = [np.frombuffer(t, "<u8") for t in batch.column(3).to_pylist()]
            names = np.zeros(len(raw), _OWNER)
            for i, field in enumerate(("hi", "lo", "n")):
                names[field] = batch.column(i).to_numpy()
            owner = np.repeat(np.arange(len(raw)), [len(t) for t in raw])
            key = np.concatenate(raw) if raw else np.zeros(0, _U)
            part = (key >> _U(8 * _TOKEN_BYTES)).astype(np.int32)
            yield from _dealt_rows(key, part, owner, names, parts, hot.value)

    return _labelled(sets.select("id", "n", "tokens"), labels).select("id", "comp", "n", "tokens").mapInArrow(run, _PACKED)


# How finely each order ranks tokens by frequency; the rest is left to its hash.
_COARSE = (1, 8, 24)


def _prefix(token: np.ndarray, kind: np.ndarray, n: int, k: int) -> np.ndarray:
    """The tokens of a set's prefix under order `k`, without those that can match nothing, which all orders put first."""
    length = n - -(-SHARED * n // OF) + 1 - (n - len(token))
    rank = mix64(token + _U(k * 0x632BE59BD9B4E019 + 1))
    return token[np.lexsort((rank, kind // _COARSE[k]))[:length]]


def _prefixes(batches):
    """(token, id, n, pos) of the prefix tokens under the first order; pos counts from 1."""
    for batch in batches:
        out = []
        for sid, n, raw, kinds in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            token = np.frombuffer(raw, "<u8")
            first = _prefix(token, np.frombuffer(kinds, np.uint8), n, 0)
            alone = n - len(token)
            out.append((first.astype(np.int64), np.full(len(first), sid), np.full(len(first), n, np.int32),
                        np.arange(alone + 1, alone + 1 + len(first), dtype=np.int32)))
        if out:
            columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "id", "n", "pos"])


def _passes(a: tuple, b: tuple, k: int) -> bool:
    """Whether two sets (n, tokens, classes) share a prefix token under order `k` with enough tokens behind the first."""
    first, second = (_prefix(token, kind, n, k) for n, token, kind in (a, b))
    _, at, other = np.intersect1d(first, second, assume_unique=True, return_indices=True)
    if not len(at):
        return False
    # Tokens left after the first shared one, itself included.
    left = min(len(a[1]) - at.min(), len(b[1]) - other.min())
    return left * (SHARED + OF) >= (a[0] + b[0]) * SHARED


def _prefix_rows(sets: DataFrame) -> DataFrame:
    rows = sets.select("id", "n", "tokens", "classes").mapInArrow(_prefixes, "token long, id long, n int, pos int")
    return materialize(rows, "prefixes")


def _enough(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column) -> Column:
    """Position filter: tokens left after a shared one suffice for the overlap that the similarity asks for."""
    left = F.least(n_a - pos_a, n_b - pos_b) + 1
    return left * (SHARED + OF) >= (n_a + n_b) * SHARED


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the filters of the other orders and reach the threshold. `b` may be in many pairs."""
    columns = ("n", "tokens", "classes")
    content = sets.select("id", *columns)
    first = join_unique(
        pairs.select(F.col("a").alias("id"), "b"), content.withColumnsRenamed({c: f"{c}_a" for c in columns}), ["id"], "inner"
    ).withColumnsRenamed({"id": "a", "b": "id"})
    both = join_unique(first, content.withColumnsRenamed({c: f"{c}_b" for c in columns}), ["id"], "inner")

    def linked(n_a, t_a, c_a, n_b, t_b, c_b) -> bool:
        a = n_a, np.frombuffer(t_a, "<u8"), np.frombuffer(c_a, np.uint8)
        b = n_b, np.frombuffer(t_b, "<u8"), np.frombuffer(c_b, np.uint8)
        if not all(_passes(a, b, k) for k in range(1, ORDERS)):
            return False
        common = np.concatenate((a[1], b[1]))
        common.sort(kind="stable")
        met = int((common[1:] == common[:-1]).sum())
        return OF * met >= SHARED * (n_a + n_b - met)

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 8)), strict=True)
            keep = pa.array([linked(*row) for row in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.select("a", "id", *[f"{c}_{side}" for side in "ab" for c in columns]).mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every end of a link: `comp` is the smallest id that links reach.

    Smallest labels move along links, and labels jump to the label of their label, until nothing changes.
    """
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    start = ends.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("comp"))
    labels = materialize(start, "labels")
    while True:
        near = join_unique(ends.withColumnRenamed("b", "id"), labels, ["id"], "inner")
        every = near.select(F.col("a").alias("id"), "comp", F.lit(None).cast("long").alias("own")).union(
            labels.select("id", "comp", F.col("comp").alias("own"))
        )
        moved = every.groupBy("id").agg(F.min("comp").alias("new"), F.max("own").alias("old"))
        target = labels.select(F.col("id").alias("new"), F.col("comp").alias("far"))
        moved = materialize(
            join_unique(moved, target, ["new"], "inner").select("id", "old", F.least("new", "far").alias("comp")), "labels"
        )
        labels = moved.select("id", "comp")
        if moved.where(F.col("old") != F.col("comp")).isEmpty():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("comp", F.col("id"))
    return join_unique(rows, labels, ["id"], "left").withColumn("comp", F.coalesce("comp", "id"))


def _leader_pairs(rows: DataFrame, step: int) -> DataFrame:
    """For each set and draw, the leader of another component that it meets in most blocks of the first order.

    A block's leaders are drawn by hashes, anew in each step, so they mostly are in the block's largest component.
    """
    rows = rows.select("token", "id", "n", "pos", "comp")
    draws = [F.min(F.struct(F.xxhash64(F.lit(step * DRAWS + d), "id").alias("h"), "comp", "id", "n", "pos")) for d in range(DRAWS)]
    blocks = rows.groupBy("token").agg(F.array(*draws).alias("leads"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    blocks = blocks.where(F.col("low") < F.col("high")).select("token", "leads")
    met = join_unique(rows, blocks, ["token"], "inner")
    near = F.filter(
        F.transform("leads", lambda lead, draw: F.struct(draw.alias("draw"), lead.alias("lead"))),
        lambda x: (x["lead"]["comp"] != F.col("comp")) & _enough(F.col("n"), F.col("pos"), x["lead"]["n"], x["lead"]["pos"]),
    )
    met = met.select("id", F.explode(near).alias("x")).select("id", "x.draw", F.col("x.lead.id").alias("leader"))
    votes = met.groupBy("id", "draw", "leader").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("id", "draw").agg(F.max(F.struct("votes", F.xxhash64("leader"), "leader")).alias("best"))
    return best.select(F.col("id").alias("a"), F.col("best.leader").alias("b")).distinct()


def _bitmaps(batches):
    """Per set: how many tokens it lists, and the parity of how many of them hash to each of `BITS` bits."""
    for batch in batches:
        raw = [np.frombuffer(t, "<u8") for t in batch.column(1).to_pylist()]
        size = np.array([len(t) for t in raw])
        bit = (mix64(np.concatenate(raw)) % _U(BITS)).astype(np.int64) if raw else np.zeros(0, np.int64)
        odd = np.bincount(np.repeat(np.arange(len(raw)), size) * BITS + bit, minlength=len(raw) * BITS) & 1
        words = np.packbits(odd.astype(np.uint8)).view("<i8").reshape(len(raw), BITS // 64)
        columns = [batch.column(0), pa.array(size.astype(np.int32)), *(pa.array(words[:, i]) for i in range(BITS // 64))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "listed", *(f"w{i}" for i in range(BITS // 64))])


def _candidates(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components that pass the filters of the first order and the bound of their bitmaps.

    Bits that differ between the bitmaps of two sets are at most as many as tokens that only one of them has, so they
    bound the overlap.
    """
    live = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    rows = join_unique(rows, live.where(F.col("low") < F.col("high")).select("token"), ["token"], "inner")
    words = [f"w{i}" for i in range(BITS // 64)]
    schema = ", ".join(["id long", "listed int", *(f"{w} long" for w in words)])
    bitmaps = sets.select("id", "tokens").mapInArrow(_bitmaps, schema)
    rows = materialize(join_unique(rows, bitmaps, ["id"], "inner"), "blocks")
    a, b = rows.alias("a"), rows.alias("b")
    other = (F.col("a.token") == F.col("b.token")) & (F.col("a.id") < F.col("b.id"))
    differ = sum((F.bit_count(F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}"))) for w in words), F.lit(0))
    size = F.col("a.n") + F.col("b.n")
    overlap = (F.col("a.listed") + F.col("b.listed") - differ) * (SHARED + OF) >= size * (2 * SHARED)
    near = _enough(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"))
    met = a.join(b, other & (F.col("a.comp") != F.col("b.comp")) & near & overlap)
    return met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def _linked(df: DataFrame, text: str, words: int, hot: Hot) -> DataFrame:
    """(hi, lo, comp) of the classes that similarity links to another one; equal `comp` where links reach."""
    spark = df.sparkSession
    parts = _parts(spark)
    held = spark.sparkContext.broadcast(hot)
    sets = _able(_dealt(df, text, words, parts, held), parts, False, held)
    sets = materialize(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    prefixes = _prefix_rows(sets)
    links, labels = None, None
    for step in range(LEADER_ROUNDS):
        pairs = _leader_pairs(_labelled(prefixes, labels), step)
        found = materialize(_verified(pairs, sets), "links")
        links = found if links is None else links.union(found)
        labels = components(links)

    # Tokens of one component cannot link it to another one: they count as those of a single set did.
    held = spark.sparkContext.broadcast(_several_components(sets, labels, hot))
    rest = _able(_dealt_again(sets, labels, parts, held), parts, True, held)
    rest = materialize(rest.select(F.col("hi").alias("id"), "n", "tokens", "classes"), "sets")
    pairs = _candidates(_labelled(_prefix_rows(rest), labels), rest)
    labels = components(links.union(materialize(_verified(pairs, rest), "links")))

    return labels.join(sets.select("id", "hi", "lo"), "id").select("hi", "lo", "comp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, n_shingles, component_id) for every row: the smallest key that similar texts reach, itself included.

    Null, empty and blank texts have no shingle and stand alone. Rows with the same key are one document. An empty
    table gives an empty result; other columns of `df` are not read.
    """
    base, hot = _classes_and_hot(df, key, text, words)
    linked = _linked(df, text, words, hot)
    smallest = base.groupBy("hi", "lo").agg(F.min("key").alias("first"))
    groups = linked.join(smallest, ["hi", "lo"])
    group = groups.groupBy("comp").agg(F.min("first").alias("component"))
    groups = join_unique(groups.select("hi", "lo", "comp"), group, ["comp"], "inner").select("hi", "lo", "component")
    classes = smallest.join(groups, ["hi", "lo"], "left").select("hi", "lo", F.coalesce("component", "first").alias("component_id"))
    return join_unique(base, classes, ["hi", "lo"], "left").select(F.col("key").alias(key), "n_shingles", "component_id")


def first_of_each_group(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row of `df` per group of similar texts: that of the smallest key; a null key comes last.

    Groups are of texts, not of keys: rows with the same key and texts that nothing links all stay, and a group
    without any key keeps a row as well. Of rows with the same key and the same set of shingles the one with the
    smallest text stays. Rows without a shingle stand alone: one per key, and all of those without a key.
    """
    bare = F.col(key).isNull() & ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rest = df.where(~bare)
    base, hot = _classes_and_hot(rest, key, text, words)
    keys = base.groupBy("hi", "lo", "key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "n")).alias("first")
    classes = materialize(keys.groupBy("hi", "lo").agg(first).select("hi", "lo", "first.*"), "first")

    # A linked class stays if its key is the smallest of its group.
    linked = materialize(_linked(rest, text, words, hot), "linked")
    leads = linked.join(classes, ["hi", "lo"]).groupBy("comp").agg(F.min(F.struct("no_key", "key", "hi", "lo")).alias("lead"))
    leads = leads.select("lead.hi", "lead.lo")
    others = linked.select("hi", "lo").join(leads, ["hi", "lo"], "left_anti")
    kept = classes.join(others, ["hi", "lo"], "left_anti")
    kept = materialize(kept.select("hi", "lo", "no_key", F.coalesce("key", F.lit(0)).alias("own"), "n"), "kept")

    rows = classes_of(rest, key, text, words, df.columns).withColumn("no_key", F.col("key").isNull())
    rows = rows.withColumn("own", F.coalesce("key", F.lit(0))).drop("key")
    names = [f"c{i}" for i in range(len(df.columns))]
    on = ["hi", "lo", "no_key", "own"]
    made = join_unique(rows, kept.where(F.col("n") == 1).drop("n"), on, "inner").select(*names)
    repeated = kept.where(F.col("n") > 1).drop("n")
    if not repeated.isEmpty():
        order = F.struct(f"c{df.columns.index(text)}", F.xxhash64(*names))
        again = join_unique(rows, repeated, on, "inner").groupBy(*on).agg(F.min_by(F.struct(*names), order).alias("row"))
        made = made.unionByName(again.select("row.*"))
    return made.toDF(*df.columns).unionByName(df.where(bare))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \\t\\n\\x0B\\f\\r]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) >= 5
    then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
met as (
  select a.doc_id as a, b.doc_id as b, count(*) as m from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by all),
links as (
  select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * m >= 75 * (x.n + y.n - m)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles,
  coalesce(least(d.doc_id, (select min(b) from reach where reach.a = d.doc_id)), d.doc_id) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id
"""

QUERIES = {"op3_jaccard_join": op3_jaccard_join}
CHECKS = {"op3_jaccard_join": _SQL}
