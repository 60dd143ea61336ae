"""Token counts by dynamic programming over prefixes.

A text is cut into pre-tokens by the vocabulary's pattern. In a pre-token the last token of every prefix is known: it is
the one vocabulary entry that ends there, encodes to itself and stays apart from the last token of the prefix before it
(BPE keeps a sequence exactly if it keeps each adjacent pair). So `count[end] = count[start of the last token] + 1`, and
one pass gives the exact token count of every prefix. An automaton over the vocabulary lists the entries that end at a
place; which pairs stay apart is found by merging the two and remembered. Adding up pre-tokens gives an array for the
whole text: entry i is the number of tokens that its first i code points encode to. Counts, truncation and budgets are
then look-ups in that array, and nothing is encoded again.

Where a prefix is cut into other pre-tokens than the whole text, its entry follows the prefix: in a run of blanks in front
of a word, in a contraction and in the string of a special token. The array is no monotone function: one more character
can take tokens away.

The vocabulary is broadcast. Tasks remember pre-tokens and pairs within `REMEMBERED_BYTES` and `REMEMBERED_PAIRS`. Long
texts go through in pieces of about `PIECE` code points, cut in front of a blank; a pre-token is never cut.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import shared, table, text_chunks

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
REMEMBERED_BYTES = 96 << 20
REMEMBERED_PAIRS = 300_000
PIECE = 1 << 18
_ENTRY = 180  # bytes that one remembered pre-token costs beside its own
_SHORT = 255  # code points of a pre-token that is remembered; it has no more tokens than fit a byte
_BATCH = 4 << 20

# Contractions of the pattern whose own prefixes are two pre-tokens.
CONTRACTIONS = ("'re", "'ve", "'ll")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others in order for the code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


class Vocabulary(NamedTuple):
    tokens: tuple[bytes, ...]  # by id; empty where no merge makes it
    merges: Mapping[tuple[int, int], tuple[int, int]]  # pair of ids: rank and id of the merged token
    special: tuple[str, ...]  # strings that are one token wherever they occur


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE from a tokenizer file in JSON. `path` is a local path or a URI."""
    if "://" in path:
        system, inner = pafs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as stream:
            told = json.loads(stream.read())
    else:
        with open(path, "rb") as stream:
            told = json.loads(stream.read())
    before = told["pre_tokenizer"] or {}
    if told["model"]["type"] != "BPE" or told.get("normalizer") or before.get("type") != "ByteLevel" or before["add_prefix_space"]:
        raise ValueError("only byte-level BPE without normalizer and prefix space")
    alphabet, ids = byte_alphabet(), told["model"]["vocab"]
    tokens = [b""] * (max(ids.values()) + 1)
    for token, number in ids.items():
        if all(c in alphabet for c in token):
            tokens[number] = bytes(alphabet[c] for c in token)
    merges = {}
    for rank, pair in enumerate(told["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left], ids[right]] = rank, ids[left + right]
    return Vocabulary(tuple(tokens), merges, tuple(t["content"] for t in told["added_tokens"]))


class PrefixCounter:
    """Token counts of all prefixes under one vocabulary; all 256 single bytes must be in it."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN):
        if missing := set(range(256)) - {t[0] for t in vocabulary.tokens if len(t) == 1}:
            raise ValueError(f"vocabulary without the single bytes {sorted(missing)}")
        self.vocabulary, self.pattern = vocabulary, pattern
        self._prepare()

    def __getstate__(self):
        return self.vocabulary, self.pattern

    def __setstate__(self, state):
        self.vocabulary, self.pattern = state
        self._prepare()

    def _prepare(self) -> None:
        tokens = self.vocabulary.tokens
        self._size = len(tokens)
        self._single = {t[0]: n for n, t in enumerate(tokens) if len(t) == 1}
        self._ends = ahocorasick.Automaton()
        for number, token in enumerate(tokens):
            if token:
                self._ends.add_word(token.decode("latin-1"), (len(token), number))
        self._ends.make_automaton()
        self._cut = regex.compile(self.pattern).findall
        self._blank = regex.compile(r"(?<=\S)\s").search
        self._blanks = regex.compile(r"\s\s").search
        self._special = regex.compile("|".join(map(regex.escape, self.vocabulary.special))).search if self.vocabulary.special else None
        self._apart: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._held = 0

    def _merged(self, raw: bytes) -> list[int]:
        """The tokens of some bytes by merging, lowest rank first, leftmost among equals."""
        find = self.vocabulary.merges.get
        part: list[int | None] = [self._single[b] for b in raw]
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        heap = [(*made, i, part[i], part[i + 1]) for i in range(len(part) - 1) if (made := find((part[i], part[i + 1])))]
        heapify(heap)
        while heap:
            _, made, i, left, right = heappop(heap)
            j = after[i]
            if part[i] != left or j == len(part) or part[j] != right:
                continue
            part[i], part[j] = made, None
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
                if new := find((made, part[after[i]])):
                    heappush(heap, (*new, i, made, part[after[i]]))
            if before[i] >= 0 and (new := find((part[before[i]], made))):
                heappush(heap, (*new, before[i], part[before[i]], made))
        return [t for t in part if t is not None]

    def _stay(self, left: int, right: int) -> bool:
        """Whether the two tokens are what their bytes together encode to; `left` is -1 at the begin."""
        key = left * self._size + right
        known = self._apart.get(key)
        if known is None:
            tokens = self.vocabulary.tokens
            if left < 0:
                known = self._merged(tokens[right]) == [right]
            else:
                known = (left, right) not in self.vocabulary.merges and self._stay(-1, right) and self._merged(tokens[left] + tokens[right]) == [left, right]
            if len(self._apart) >= REMEMBERED_PAIRS:
                self._apart.clear()
            self._apart[key] = known
        return known

    def _in_bytes(self, raw: bytes) -> list[int]:
        """Token counts of the prefixes of a pre-token of 0, 1, 2, ... bytes."""
        count, last = [0] * (len(raw) + 1), [-1] * (len(raw) + 1)
        known, stay, width, done = self._apart.get, self._stay, self._size, 0
        for at, (size, token) in self._ends.iter(raw.decode("latin-1")):
            if at < done:
                continue
            start = at + 1 - size
            left = last[start]
            apart = known(left * width + token)
            if stay(left, token) if apart is None else apart:
                done = at + 1
                count[done], last[done] = count[start] + 1, token
        return count

    def _in_piece(self, piece: str) -> list[int]:
        """Token counts of the prefixes of a pre-token of 1, 2, ... code points."""
        raw = piece.encode()
        counts = self._in_bytes(raw)
        if len(raw) != len(piece):
            # A prefix ends where the next byte is no continuation of a character.
            counts = [0, *(n for n, after in zip(counts[1:], raw[1:] + b" ", strict=True) if after & 0xC0 != 0x80)]
        if piece in CONTRACTIONS:
            counts[2] = sum(self._in_bytes(c.encode())[-1] for c in piece[:2])
        return counts[1:]

    def _look_up(self, pieces: Sequence[str]) -> list[bytes]:
        """Counts of each of some pre-tokens of at most `_SHORT` code points, a byte each."""
        known = self._known
        if new := set(pieces).difference(known):
            if self._held > REMEMBERED_BYTES:
                known.clear()
                self._held, new = 0, set(pieces)
            for piece in new:
                known[piece] = bytes(self._in_piece(piece))
            self._held += sum(map(len, new)) * 2 + len(new) * _ENTRY
        return list(map(known.__getitem__, pieces))

    def _plain(self, text: str) -> tuple[np.ndarray, str]:
        """Counts of the prefixes of 1, 2, ... code points of a text without special strings, and its last pre-token."""
        if not text:
            return np.empty(0, np.int32), ""
        pieces = self._cut(text)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if sizes.max() <= _SHORT:
            counts = np.frombuffer(b"".join(self._look_up(pieces)), np.uint8).astype(np.int32)
        else:
            short = dict.fromkeys(p for p in pieces if len(p) <= _SHORT)
            short = dict(zip(short, self._look_up(list(short)), strict=True))
            counts = np.concatenate([
                np.frombuffer(short[p], np.uint8).astype(np.int32) if p in short else np.array(self._in_piece(p), np.int32) for p in pieces
            ])
        ends = np.cumsum(sizes)
        totals = counts[ends - 1]
        base = np.cumsum(totals) - totals
        counts += np.repeat(base.astype(np.int32), sizes)
        if self._blanks(text):
            for k, piece in enumerate(pieces[:-1]):
                # One more blank than the run in front of a word has: the prefix is a run of its own.
                if piece.isspace() and pieces[k + 1][0].isspace():
                    counts[ends[k]] = base[k] + self._in_piece(piece + pieces[k + 1][0])[-1]
        return counts, pieces[-1]

    def _pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in parts that are encoded apart, and whether a special string follows the part."""
        at = 0
        while at < len(text):
            hit = self._special(text, at) if self._special else None
            stop = hit.start() if hit else len(text)
            while stop - at > PIECE and (cut := self._blank(text, at + PIECE, stop)):
                yield text[at : cut.start()], False
                at = cut.start()
            yield text[at:stop], bool(hit)
            at = hit.end() if hit else len(text)
            if hit:
                yield hit.group(), False

    def counts(self, text: str | None) -> Iterator[np.ndarray]:
        """Token counts of the prefixes of 0, 1, 2, ... code points, in consecutive arrays; null is empty."""
        yield np.zeros(1, np.int32)
        total, held = 0, None
        for part, before_special in self._pieces(text or ""):
            if held is not None:
                # Inside a special string the prefix is plain text and runs on from the last pre-token.
                (base, tail), held = held, None
                inside = self._plain(tail + part[:-1])[0][len(tail) :] + np.int32(base)
                total += 1
                yield np.append(inside, np.int32(total)).astype(np.int32)
                continue
            counts, tail = self._plain(part)
            if before_special:
                first = len(counts) - len(tail)
                held = total + (int(counts[first - 1]) if first else 0), tail
            if len(counts):
                yield counts + np.int32(total)
                total += int(counts[-1])


@lru_cache(maxsize=2)
def load_counter(path: str, pattern: str = public_tokenizers.PATTERN) -> PrefixCounter:
    return PrefixCounter(read_vocabulary(path), pattern)


def _mapped(df: DataFrame, text: str, path: str, fields: list[T.StructField], row, keep: Sequence[str] | None) -> DataFrame:
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    held = shared(df.sparkSession, ("tokencounts", path), lambda: load_counter(path))
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], *fields])

    def run(batches):
        counter = held.value
        for batch in batches:
            for start, texts in text_chunks(batch.column(len(kept)), _BATCH):
                values = [row(counter, text) for text in texts]
                part = batch.slice(start, len(texts))
                made = [pa.array(c, _ARROW[f.dataType]) for c, f in zip(zip(*values, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], [*kept, *(f.name for f in fields)])

    return rows.mapInArrow(run, schema)


_COUNTS = T.ArrayType(T.IntegerType(), False)
_ARROW = {_COUNTS: pa.list_(pa.field("element", pa.int32(), False)), T.LongType(): pa.int64()}


def prefix_counts(df: DataFrame, path: str = VOCABULARY, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns `keep` of `df` (all, if not given) and `token_counts`: entry i + 1 is the token count of i code points.

    A null or empty text has the one entry 0. A column named `token_counts` in `df` is replaced. `tokens_of_prefix`,
    `fitting_prefix` and `truncated` answer from the array.
    """
    fields = [T.StructField("token_counts", _COUNTS)]
    return _mapped(df, text, path, fields, lambda counter, text: (np.concatenate(list(counter.counts(text))),), keep)


def tokens_of_prefix(counts: Column, length: Column | int) -> Column:
    """Tokens of the first `length` code points; beyond the text those of all of it."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.element_at(counts, F.least(length.cast("int") + 1, F.size(counts)))


def fitting_prefix(counts: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix with at most `budget` tokens; a negative budget gives -1."""
    last = F.array_position(F.reverse(F.transform(counts, lambda c: c <= budget)), True).cast("int")
    return F.when(last > 0, F.size(counts) - last).otherwise(-1)


def truncated(text: Column, counts: Column, budget: Column | int) -> Column:
    """The longest prefix of the text with at most `budget` tokens; null stays null."""
    return F.substring(text, F.lit(1), F.greatest(fitting_prefix(counts, budget), F.lit(0)))


def budgets(df: DataFrame, limit: int = LIMIT, path: str = VOCABULARY, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """`n_tokens` of the whole text and `fitting`, the code points of its longest prefix with at most `limit` tokens.

    Both are read from the prefix counts, which do not leave the task. A null or empty text has 0 and 0.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")

    def row(counter: PrefixCounter, text: str | None):
        total = seen = fitting = 0
        for counts in counter.counts(text):
            total = int(counts[-1])
            below = np.flatnonzero(counts <= limit)
            if len(below):
                fitting = seen + int(below[-1])
            seen += len(counts)
        return total, fitting

    return _mapped(df, text, path, [T.StructField("n_tokens", T.LongType()), T.StructField("fitting", T.LongType())], row, keep)


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fitting (code points within the limit) of every document."""
    documents = table(spark, folder, "documents")
    rows = documents.select("doc_id", "text", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"))
    counted = budgets(rows, keep=["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fitting")


QUERIES = {"op12_token_counts": op12_token_counts}
CHECKS: dict[str, str] = {}
