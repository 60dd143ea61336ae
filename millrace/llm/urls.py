"""URL filters by a cascade of Bloom filters, with native expressions only.

A Bloom filter of the listed keys also passes some others. Over the corpus's complete set of candidate keys these
are known: the next level encodes them, the one after that the listed keys which the level before passes by mistake,
and so on, alternating, until no key of the corpus is mistaken. Then membership is exact for every key of the
corpus, from the filters' bits alone: they are constants of the plan, and judging urls needs no join.

The first level's size follows from the list and the number of candidate keys, so that few false positives remain;
later levels are small. Lists whose filters would pass `MAX_BITS` are joined instead.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name, table
from millrace.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_BITS = 1 << 24
BLOCK, ALLOW = "block", "allow"
# (host, path, verdict) of the registered query.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and for a url without `://`.

    The host goes from behind the first `://` to `/`, `?`, `#` or the end, the path on to `?`, `#` or the end.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, depths: list[int], lengths: list[int]) -> Column:
    """Every `host suffix + path prefix` that a rule with one of the depths (labels) and path lengths could equal."""
    labels = F.split(host, r"\.", -1)
    made = []
    for depth in depths:
        suffix = F.array_join(F.slice(labels, F.lit(-depth), F.lit(depth)), ".")
        for length in lengths:
            fits = (F.size(labels) >= depth) & (F.char_length(path) >= length)
            made.append(F.when(fits, F.concat(suffix, F.left(path, F.lit(length)))))
    return F.filter(F.array(*made), lambda key: key.isNotNull()) if made else F.array().cast("array<string>")


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    salt: int
    words: tuple[int, ...]


def _places(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(salt * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def _encoded(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """A Bloom filter of `n` keys (column `key`) with the given false positive rate."""
    bits = max(64, 64 * ceil(n * log2(1 / rate) / log(2) / 64))
    hashes = max(1, round(log2(1 / rate)))
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits, hashes, salt))).alias("place"))
    words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("mask")
    )
    held = [0] * (bits // 64)
    for row in words.collect():  # at most MAX_BITS / 64 rows
        held[row["word"]] = row["mask"]
    return Level(bits, hashes, salt, tuple(held))


def _passes(level: Level, key: Column) -> Column:
    words = F.from_json(F.lit(json.dumps(level.words)), "array<bigint>")  # constant, evaluated when Spark plans
    tests = [
        F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
        for place in _places(key, level.bits, level.hashes, level.salt)
    ]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def build_cascade(universe: DataFrame, listed: DataFrame, salt: int = 0) -> list[Level]:
    """Levels that tell the keys of `listed` from the others of `universe` (column `key`, distinct). May be empty.

    Only the words of the filters and counts reach the driver.
    """
    listed = materialize(listed.join(universe, "key", "left_semi"), "listed")
    inside, n = listed, listed.count()
    outside, n_out = None, universe.count() - n
    if not n:
        return []
    levels: list[Level] = []
    while n:
        # The rate that makes about as many mistakes as there are keys, halved: then the next level is small.
        level = _encoded(inside, n, min(0.5, 0.5 * n / max(1, n_out)), salt + len(levels))
        levels.append(level)
        if outside is None:
            outside = universe.join(listed, "key", "left_anti")
        mistaken = materialize(outside.where(_passes(level, F.col("key"))), "mistaken")
        inside, outside = mistaken, inside
        n, n_out = mistaken.count(), n
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """Exact for keys of the universe: the first level that rejects a key decides, by its number."""
    if not levels:
        return F.lit(False)
    told = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        told = F.when(_passes(levels[number], key), told).otherwise(F.lit(number % 2 == 1))
    return told


def judge(df: DataFrame, rules: DataFrame, url: str = "url", max_bits: int = MAX_BITS, default: str = ALLOW) -> DataFrame:
    """`df` with host, path, rule (`host + path` of the longest rule that fits, or null) and verdict.

    `rules` has host, path and verdict (block or allow); a rule fits its host and all subdomains where the path
    begins with the rule's. Where the same rule is in both lists, allow wins. Urls that no rule fits get `default`.
    Columns of these names in `df` are replaced. Rows with equal urls are judged alike; an empty table stays empty.
    """
    added = ("host", "path", "rule", "verdict")
    host, path = host_and_path(F.col(url))
    rows = df.drop(*added).withColumn("host", host).withColumn("path", path)
    listed = rules.where("host is not null and path is not null and verdict in ('block', 'allow')")
    listed = listed.select(
        F.concat(F.translate("host", _UPPER, _UPPER.lower()), "path").alias("key"),
        F.size(F.split("host", r"\.", -1)).alias("depth"),
        F.char_length("path").alias("length"),
        "verdict",
    ).distinct()
    listed = materialize(listed, "rules")
    # Rule shapes: as many as there are label counts and path lengths in the rules.
    depths = [r[0] for r in listed.select("depth").distinct().orderBy("depth").collect()]
    lengths = [r[0] for r in listed.select("length").distinct().orderBy("length").collect()]
    keys = free_name(rows, "_keys")
    rows = rows.withColumn(keys, candidate_keys(F.col("host"), F.col("path"), depths, lengths))
    allowed = listed.where(F.col("verdict") == ALLOW).select("key")
    blocked = listed.where(F.col("verdict") == BLOCK).select("key").join(allowed, "key", "left_anti")

    universe = materialize(rows.select(F.explode(keys).alias("key")).distinct(), "universe")
    n, size = listed.count(), universe.count()
    if n * (2 + log2(1 + size / max(1, n))) / log(2) > max_bits:
        fit = universe.join(allowed.withColumn("v", F.lit(ALLOW)).union(blocked.withColumn("v", F.lit(BLOCK))), "key")
        return _judged_by_join(rows, keys, fit, default)
    allow, block = build_cascade(universe, allowed), build_cascade(universe, blocked, salt=1000)
    told = F.transform(
        F.col(keys),
        lambda key: F.struct(
            F.char_length(key).alias("n"),
            key.alias("key"),
            F.when(is_listed(allow, key), ALLOW).when(is_listed(block, key), BLOCK).alias("verdict"),
        ),
    )
    best = F.array_max(F.filter(told, lambda k: k["verdict"].isNotNull()))
    return _with_verdict(rows.withColumn(keys, best), keys, default)


def _with_verdict(rows: DataFrame, best: str, default: str) -> DataFrame:
    return rows.select(
        *[F.col(f"`{c}`") for c in rows.columns if c != best],
        F.col(best)["key"].alias("rule"),
        F.coalesce(F.col(best)["verdict"], F.lit(default)).alias("verdict"),
    )


def _judged_by_join(rows: DataFrame, keys: str, fit: DataFrame, default: str) -> DataFrame:
    """The same verdicts for lists of any size. Hosts and paths are judged once each, however many urls they have."""
    place = rows.select("host", "path", F.explode(keys).alias("key")).distinct()
    met = place.join(fit, "key").groupBy("host", "path").agg(
        F.max(F.struct(F.char_length("key").alias("n"), "key", F.col("v").alias("verdict"))).alias("_best")
    )
    return _with_verdict(rows.drop(keys).join(met, ["host", "path"], "left"), "_best", default)


def op8_bloom_cascade(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


_SQL = """
with split_urls as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split_urls),
rules(h, p, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from parts join rules on (host = h or host like '%.' || h) and starts_with(path, p) group by page_id)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(verdict, 'allow') as verdict
from parts left join fits using (page_id)
"""

QUERIES = {"op8_bloom_cascade": op8_bloom_cascade}
CHECKS = {"op8_bloom_cascade": _SQL}
