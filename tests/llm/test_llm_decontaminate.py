"""Benchmark decontamination against a scan of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    met |= {str(x) for x in windows[tuple(w[i : i + n])] if x is not None}
        out.append((doc, len(w), len(hit), len(met), ",".join(sorted(met)), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (10, " ".join(f"q{i}" for i in range(14))),
    (9, "Only four WORDS here"),
    (8, "only four words here"),
    (7, None),
    (6, "... !!"),
    (5, "é É 7"),
    (None, "id of mine is null"),
    (4, " ".join(f"q{i}" for i in range(4, 14))),
]


def documents():
    pick = random.Random(3)
    q = [f"Q{i}" for i in range(14)]
    docs = [
        (0, None), (1, ""), (2, "--"), (3, " ".join(q)), (4, ", ".join(q[1:11])), (5, " ".join(q[1:10])),
        (6, "so only-four words (here) only four words here"), (7, "É é 7 é É 7"), (8, "this id of mine is null here"),
        (9, " ".join(pick.choice("abcdefgh") for _ in range(50_000)) + " " + " ".join(q) * 2), (3, " ".join(q)),
        (11, " ".join(q[:11] + q[:12])),
    ]
    return docs


def marked(spark, docs, items, **options):
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as hits", "1 as n_hit")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.mark(rows, bench, **options)
    out = out.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"max_windows": 0}])
def test_same_as_all_windows(spark, options):
    docs = documents()
    assert marked(spark, docs, ITEMS, **options) == brute(docs, ITEMS)


@pytest.mark.parametrize("options", [{}, {"max_windows": -1}])
def test_empty_tables(spark, options):
    assert marked(spark, [], ITEMS, **options) == []
    assert marked(spark, [(1, "some words")], [], **options) == [(1, 2, 0, 0, "", False)]


def test_documents_and_spans_go(spark):
    docs = spark.createDataFrame([(1, "Keep (only FOUR words here) this"), (2, "clean, text"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.without_spans(docs, bench).collect()}
    assert cut == {1: "Keep (   ) this", 2: "clean, text", 3: None}


def test_plan_is_native_and_without_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontaminate.mark(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
