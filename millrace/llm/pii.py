"""Personal data: exact base forms, and identifiers found through their contexts.

Base forms (email, ip, card, phone) are found in one pass over whole texts. They are the seeds of a bootstrap: the
words around a seed are lexical patterns of its kind. Identifiers of a looser form are candidates. Patterns and
values form a graph; Spark scores it in rounds: a pattern by the share of known values among those it surrounds, a
value by the patterns around it (noisy or). A pattern with enough different seeds and a high score discovers the
candidates in its place, such as a phone number without its plus sign. Values around patterns of a higher score are
seeds of the next pass, until a pass finds no new one.

Spans depend on texts alone, so what is discovered is joined to texts by two hashes of theirs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import table, text_key
from millrace.operators.joins import join_unique
from millrace.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Rounds of one pass. More of them would draw every pattern with seeds towards 1; what is found counts in the next pass.
ROUNDS = 2
# A pattern needs so many different seeds, and such a score, to discover.
MIN_SEEDS = 3
MIN_SCORE = 0.6
# Values around a pattern with such a score count as seeds in the next pass.
SURE_SCORE = 0.75
# Broadcast discovered spans only up to so many texts; more are joined by shuffle.
MAX_BROADCAST = 100_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its first digit only, and never given back: the same matches in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Looser forms of the kinds, for candidates.
_LOOSE_EMAIL = re.compile(r"(?<![^\s@<>()\",;])[^\s@<>()\",;]++@[^\s@<>()\",;]++")
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,5}")
_LOOSE_NUMBER = re.compile(r"(?<![^\W_])[0-9]++(?:[ ().-]{1,2}[0-9]++)*+(?![^\W_])")
_NUMBER_SIGNS = str.maketrans("", "", " ().-+")
_EDGE = ".,;:!?\"'()[]{}<>|"
# A longer word is known by as many characters next to the place, and no context reaches beyond it.
_WORD_CHARS = 80


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            floor = match.end()
            found.append((begin, floor))
        else:
            floor = at + 1
        at = text.find("@", floor)
    return found


def _ip(value: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in value.split("."))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, begin, end) by kind as listed, then begin; code points. A match that fails its test is dropped."""
    if not text:
        return []
    spans = [(0, b, e) for b, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [(1, *m.span()) for m in _IP.finditer(text) if _ip(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans.append((3, *m.span()))
    return spans


def _apart(spans: Sequence[tuple[int, int, int]], others: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans (kind, begin, end), in order of their begin, that meet none of `others`."""
    taken = sorted((b, e) for _, b, e in others)
    free, i = [], 0
    for kind, begin, end in spans:
        while i < len(taken) and taken[i][1] <= begin:
            i += 1
        if i == len(taken) or taken[i][0] >= end:
            free.append((kind, begin, end))
    return free


def loose_spans(text: str, known: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates: looser forms of the kinds that meet no base span. Of forms that meet, the address counts before the number.

    Digits next to a letter are no number: they belong to a word or to a secret in hex.
    """
    found = []
    if "@" in text:
        found = [(0, *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += _apart([(1, *m.span()) for m in _LOOSE_IP.finditer(text)], found)
        numbers = []
        for m in _LOOSE_NUMBER.finditer(text):
            n = len(m.group().translate(_NUMBER_SIGNS))
            if 7 <= n <= 19:
                numbers.append((3 if n < 13 else 2, *m.span()))
        found += _apart(numbers, found)
    found.sort(key=lambda s: s[1])
    return _apart(found, known)


def _words_beside(text: str, at: int, step: int, n: int) -> list[str]:
    """The first `n` words met from `at` on, backwards if `step` is -1, in any distance."""
    words: list[str] = []
    edge = len(text) if step > 0 else 0
    ahead = 0 if step > 0 else -1
    while at != edge and len(words) < n:
        while at != edge and text[at + ahead].isspace():
            at += step
        begin = at
        while at != edge and abs(at - begin) < _WORD_CHARS and not text[at + ahead].isspace():
            at += step
        word = text[min(begin, at) : max(begin, at)].lower().strip(_EDGE)
        if word:
            words.append(re.sub("[0-9]", "0", word))
        if at != edge and not text[at + ahead].isspace():
            break
    return words


def patterns_at(text: str, begin: int, end: int) -> list[str]:
    """The lexical patterns of a place: the two words before it, and the words on both sides."""
    left = _words_beside(text, begin, -1, 2)[::-1]
    right = _words_beside(text, end, 1, 1)
    made = []
    if len(left) == 2:
        made.append(f"{left[0]} {left[1]} _")
    if left and right:
        made.append(f"{left[-1]} _ {right[0]}")
    return made


_SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("kind", "begin", "stop")])
_PLACE = T.StructType(
    [*_SPAN.fields, T.StructField("seed", T.BooleanType()), T.StructField("value", T.StringType()),
     T.StructField("patterns", T.ArrayType(T.StringType()))]
)
_SPAN_ARROW = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "begin", "stop")]))
_PLACE_ARROW = pa.list_(
    pa.struct([*_SPAN_ARROW.value_type, ("seed", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
)


def _places(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    made = []
    for seed, spans in ((True, base), (False, loose_spans(text, base))):
        for kind, begin, stop in spans:
            patterns = patterns_at(text, begin, stop)
            if patterns:
                value = text[begin:stop].lower()
                value = value.translate(_NUMBER_SIGNS) if kind > 1 else value
                made.append({"kind": kind, "begin": begin, "stop": stop, "seed": seed, "value": value, "patterns": patterns})
    return made


def scan(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns `keep`, two hashes of the text, its base spans, and its places: seeds and candidates."""
    high, low = text_key(F.col(text))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], high.alias("_high"), low.alias("_low"), F.col(text).alias("__text"))

    def run(batches):
        for batch in batches:
            base, places = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                spans = base_spans(value)
                base.append([{"kind": k, "begin": b, "stop": e} for k, b, e in spans])
                places.append(_places(value, spans) if value else [])
            columns = [*batch.columns[:-1], pa.array(base, _SPAN_ARROW), pa.array(places, _PLACE_ARROW)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_base", "_places"])

    added = [T.StructField("_base", T.ArrayType(_SPAN)), T.StructField("_places", T.ArrayType(_PLACE))]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *added]))


def score_patterns(
    edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE
) -> DataFrame:
    """(kind, pattern, score) of the patterns that may discover.

    `edges`: distinct (kind, pattern, value, seed). Each round scores patterns by the mean score of their values,
    then values by 1 - product of (1 - score) over their patterns with enough seeds; seeds keep 1.
    """
    return _scored(materialize(edges, "edges"), rounds, min_seeds).where(F.col("strength") >= min_score).select(
        "kind", "pattern", F.col("strength").alias("score")
    )


def _scored(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(kind, pattern, strength, seeds) of the patterns with enough seeds."""
    values = edges.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    patterns = None
    for step in range(rounds):
        met = join_unique(edges, values, ["kind", "value"], "inner")
        seeds = F.sum(F.col("seed").cast("long"))
        patterns = met.groupBy("kind", "pattern").agg(F.avg("score").alias("strength"), seeds.alias("seeds"))
        patterns = materialize(patterns.where(F.col("seeds") >= min_seeds), "patterns")
        if step + 1 < rounds:
            around = join_unique(edges, patterns, ["kind", "pattern"], "inner")
            missed = F.exp(F.sum(F.log(1 - F.least("strength", F.lit(0.999)))))
            near = around.groupBy("kind", "value").agg((1 - missed).alias("near"))
            values = values.join(near, ["kind", "value"], "left").select(
                "kind", "value", F.when(F.col("score") == 1, 1.0).otherwise(F.coalesce("near", F.lit(0.0))).alias("score")
            )
            values = materialize(values, "values")
    return patterns


def bootstrapped_patterns(edges: DataFrame) -> DataFrame:
    """(kind, pattern, score) of the patterns that may discover, after as many passes as find new seeds.

    A pass scores patterns as `score_patterns` does; values around those of a sure score are seeds of the next one.
    Seeds only grow in number, so the passes end. A pattern that qualified once stays.
    """
    edges = materialize(edges, "edges")
    current, known, n_known, every = edges, None, 0, None
    while True:
        patterns = _scored(current)
        every = patterns if every is None else every.union(patterns)
        sure = patterns.where(F.col("strength") >= SURE_SCORE).select("kind", "pattern")
        around = join_unique(edges, sure, ["kind", "pattern"], "inner").select("kind", "value")
        known = materialize((around if known is None else around.union(known)).distinct(), "known")
        before, n_known = n_known, known.count()
        if n_known == before:
            return every.groupBy("kind", "pattern").agg(F.max("strength").alias("score")).where(F.col("score") >= MIN_SCORE)
        marked = join_unique(edges, known.withColumn("known", F.lit(True)), ["kind", "value"], "left")
        marked = marked.groupBy("kind", "pattern", "value").agg(F.max(F.col("seed") | F.coalesce("known", F.lit(False))).alias("seed"))
        current = materialize(marked, "edges")


def discover(scanned: DataFrame) -> DataFrame:
    """(_high, _low, _found): the spans that patterns discover in each text that has any."""
    place = scanned.select("_high", "_low", F.explode("_places").alias("p"))
    places = place.select("_high", "_low", "p.kind", "p.begin", "p.stop", "p.seed", "p.value", F.explode("p.patterns").alias("pattern"))
    patterns = bootstrapped_patterns(places.select("kind", "pattern", "value", "seed").distinct())
    met = join_unique(places.where(~F.col("seed")), patterns.drop("score"), ["kind", "pattern"], "inner")
    spans = met.select("_high", "_low", F.struct("kind", "begin", "stop").alias("span")).distinct()
    return spans.groupBy("_high", "_low").agg(F.collect_list("span").alias("_found"))


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with the discovered spans of their texts, null where there are none."""
    found = materialize(found, "found")
    n = found.count()
    if not n:
        return rows.withColumn("_found", F.lit(None).cast(T.ArrayType(_SPAN)))
    if n <= MAX_BROADCAST:
        return rows.join(F.broadcast(found), ["_high", "_low"], "left")
    return join_unique(rows, found, ["_high", "_low"], "left")


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["begin"].cast("string"), s["stop"].cast("string"))), ","
    )


def find(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, then n_email, n_ip, n_card, n_phone, base and spans (both `kind:begin:end`, joined by commas).

    `spans` has the base spans and the discovered ones, by kind, then begin. Null and empty texts have none; equal
    texts get equal spans. Columns of `keep` must not have these names.
    """
    scanned = materialize(scan(df, text, keep), "places")
    rows = _with_found(scanned.drop("_places"), discover(scanned))
    kinds = F.transform("_base", lambda s: s["kind"])
    count = [(F.size("_base") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{name}") for i, name in enumerate(KINDS)]
    every = F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_found", F.array().cast(T.ArrayType(_SPAN))))))
    return rows.select(*[F.col(f"`{c}`") for c in keep], *count, _listed(F.col("_base")).alias("base"), _listed(every).alias("spans"))


def _redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each stretch of spans becomes the name of its first one."""
    out, upto = [], 0
    for begin, stop, kind in sorted((b, e, k) for k, b, e in spans):
        if begin >= upto:
            out += [text[upto:begin], f"[{KINDS[kind].upper()}]"]
        upto = max(upto, stop)
    return "".join([*out, text[upto:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with every span of personal data replaced by `[EMAIL]`, `[IP]`, `[CARD]` or `[PHONE]`; all rows stay.

    Null and clean texts are unchanged. Overlapping spans become one, named by the first.
    """
    high, low = text_key(F.col(text))
    found = discover(materialize(scan(df, text, []), "places"))
    rows = _with_found(df.withColumn("_high", high).withColumn("_low", low), found).drop("_high", "_low")
    at = rows.columns.index(text)

    def run(batches):
        for batch in batches:
            column = []
            for value, more in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                spans = base_spans(value) + [(s["kind"], s["begin"], s["stop"]) for s in more or []]
                column.append(_redacted(value, spans) if spans else value)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(column, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1])).select(*df.columns)


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents"))
    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {"op9_pii": op9_pii}
CHECKS: dict[str, str] = {}
