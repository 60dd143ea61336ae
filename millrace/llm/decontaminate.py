"""Benchmark decontamination by windows of words, with native expressions only.

The windows of the test items are hashed and put into a table of buckets that is part of the plan: an array of
buckets, found by position, of a few entries each. Documents are scanned window by window; a window whose hash is in
its bucket is verified by its words. One pass over the documents, without a shuffle.

The table goes into the plan only if the items have at most `MAX_WINDOWS` windows; beyond that the windows of the
documents are joined to those of the items, with the same result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name, table
from millrace.session import materialize

WINDOW = 10
MAX_WINDOWS = 1 << 18
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HITS = "array<struct<begin:int,stop:int,items:array<string>>>"


def normal_words(text: Column) -> Column:
    """Words after A-Z became a-z: runs of digits, a-z and all that is not ASCII. Null has none."""
    found = F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(_WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _window(words: Column, begin: Column, length: int) -> Column:
    return F.slice(words, begin + 1, F.lit(length))


def _begins(words: Column, length: int) -> Column:
    """Where windows of `length` words begin, from 0; none in a shorter text."""
    return F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(
        F.array().cast("array<int>")
    )


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(length, hash, content, items): every different window of the items, with the ids it belongs to, as strings.

    An item with fewer words than a window is one window; one without words has none. Items with equal windows share
    them. An item with a null id marks words, but is not listed.
    """
    words = benchmark.select(F.col(item).cast("string").alias("item"), normal_words(F.col(text)).alias("words"))
    length = F.least(F.size("words"), F.lit(window))
    begins = words.where(F.size("words") > 0).select(
        "item", "words", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("begin")
    )
    content = F.expr("slice(words, begin + 1, length)")
    rows = begins.select("item", "length", F.xxhash64(content).alias("hash"), F.array_join(content, " ").alias("content"))
    return rows.groupBy("length", "hash", "content").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _found(words: Column, length: int, windows: list) -> Column:
    """The verified windows of one length in a text, by begin."""
    size = 8 * len(windows)
    buckets: list[list] = [[] for _ in range(size)]
    for w in windows:
        buckets[w["hash"] % size].append({"h": w["hash"], "c": w["content"], "i": w["items"]})
    # A constant expression: Spark evaluates it once, when it plans.
    held = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<h:bigint,c:string,i:array<string>>>>")

    def entries(begin: Column) -> Column:
        return F.get(held, F.pmod(F.xxhash64(_window(words, begin, length)), F.lit(size)).cast("int"))

    def same(entry: Column, begin: Column) -> Column:
        own = _window(words, begin, length)
        return (entry["h"] == F.xxhash64(own)) & (entry["c"] == F.array_join(own, " "))

    def hit(begin: Column) -> Column:
        entry = F.get(F.filter(entries(begin), lambda e: same(e, begin)), F.lit(0))
        return F.struct(begin.alias("begin"), (begin + length).alias("stop"), entry["i"].alias("items"))

    begins = F.filter(_begins(words, length), lambda begin: F.exists(entries(begin), lambda e: same(e, begin)))
    return F.transform(begins, lambda begin: hit(begin))


def _scan(words: Column, windows: list) -> Column:
    """The verified windows of a text, by begin, looked up in a table that is part of the expression."""
    lengths = sorted({w["length"] for w in windows})
    found = [_found(words, length, [w for w in windows if w["length"] == length]) for length in lengths]
    if not found:
        return F.array().cast(_HITS)
    return F.array_sort(F.concat(*found)) if len(found) > 1 else found[0]


def _scan_by_join(rows: DataFrame, words: str, hits: str, windows: DataFrame) -> DataFrame:
    """As `_scan`, for windows of any number: the windows of the texts are joined to those of the items."""
    key = free_name(rows, "_row")
    rows = materialize(rows.withColumn(key, F.monotonically_increasing_id()), "texts")
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]  # at most WINDOW
    own = None
    for length in lengths:
        begin = rows.select(key, words, F.explode(_begins(F.col(words), length)).alias("begin"))
        content = _window(F.col(words), F.col("begin"), length)
        part = begin.select(
            key, "begin", F.lit(length).alias("length"), F.xxhash64(content).alias("hash"), F.array_join(content, " ").alias("content")
        )
        own = part if own is None else own.unionByName(part)
    if own is None:
        return rows.drop(key).withColumn(hits, F.array().cast(_HITS))
    met = own.join(windows, ["length", "hash", "content"])
    found = F.struct("begin", (F.col("begin") + F.col("length")).alias("stop"), "items")
    grouped = met.groupBy(key).agg(F.array_sort(F.collect_list(found)).alias(hits))
    filled = F.coalesce(F.col(hits), F.array()).cast(_HITS)
    return rows.join(grouped, key, "left").withColumn(hits, filled).drop(key)


def _covered(hits: Column) -> Column:
    """How many words lie in a hit; hits are sorted by begin."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, hit: Column) -> Column:
        fresh = F.greatest(F.lit(0), hit["stop"] - F.greatest(state["upto"], hit["begin"]))
        return F.struct(F.greatest(state["upto"], hit["stop"]).alias("upto"), (state["n"] + fresh).alias("n"))

    return F.aggregate(hits, start, add, lambda state: state["n"])


def mark(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """`documents` with n_words, n_hit, n_items, items (sorted strings), contaminated and hits (word spans).

    A document word inside any occurrence of an item's window is hit. Null, empty and wordless texts have no words
    and are not contaminated; without items nothing is. Repeated rows are marked alike. Columns of these names in
    `documents` are replaced.
    """
    added = ("n_words", "n_hit", "n_items", "items", "contaminated", "hits")
    rows = documents.drop(*added)
    words = free_name(rows, "_words")
    rows = rows.withColumn(words, normal_words(F.col(text)))
    windows = materialize(item_windows(benchmark, window=window), "windows")
    if windows.count() <= max_windows:
        rows = rows.withColumn("hits", _scan(F.col(words), windows.collect()))
    else:
        rows = _scan_by_join(rows, words, "hits", windows)
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return rows.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in (words, "hits")],
        F.size(words).cast("long").alias("n_words"),
        _covered(F.col("hits")).alias("n_hit"),
        items.alias("items"),
        F.col("hits"),
    ).select(
        "*",
        F.size("items").cast("long").alias("n_items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `documents` that hold no window of an item, unchanged.

    The mark goes through a generator, below which Spark does not push the filter: pushed down, the condition would
    hold the whole scan, and split a text into words anew for each of its windows.
    """
    marked = mark(documents, benchmark, text)
    flag = free_name(documents, "_hit")
    kept = marked.select(*[F.col(f"`{c}`") for c in documents.columns], F.explode(F.array("contaminated")).alias(flag))
    return kept.where(~F.col(flag)).select(*documents.columns)


def without_spans(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """`documents` without the words of their hits; what stood between words stays. Clean texts are unchanged."""
    marked = mark(documents, benchmark, text)
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = F.regexp_extract_all(F.col(text), F.lit(word), F.lit(0))
    between = F.split(F.col(text), word, -1)
    kept = F.transform(
        words,
        lambda w, i: F.concat(
            F.get(between, i),
            F.when(F.exists("hits", lambda h: (h["begin"] <= i) & (i < h["stop"])), F.lit("")).otherwise(w),
        ),
    )
    rest = F.concat(F.array_join(kept, ""), F.element_at(between, -1))
    return marked.withColumn(text, F.when(F.col("contaminated"), rest).otherwise(F.col(text))).select(*documents.columns)


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    marked = mark(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return marked.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


_SQL = r"""
with lowered as (
  select 'd' as kind, doc_id as id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
  union all
  select 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
words as (select kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from lowered),
items as (
  select id as item_id, least(len(w), 10) as n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
    lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as content
  from words where kind = 'b' and len(w) > 0),
sizes as (select distinct n from items),
windows as (
  select doc_id, n, p as begin, array_to_string(w[p:p + n - 1], ' ') as content from (
    select words.id as doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from words, sizes where kind = 'd')),
hits as (
  select doc_id, begin, n, item_id from windows join items using (n, content)),
hit_words as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(begin, begin + n)) as p from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids from (
    select distinct doc_id, item_id::varchar as i from hits) group by doc_id)
select id as doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit_words on hit_words.doc_id = id left join hit_items on hit_items.doc_id = id where kind = 'd'
"""

QUERIES = {"op6_decontaminate": op6_decontaminate}
CHECKS = {"op6_decontaminate": _SQL}
