"""N-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard


def shingles(text):
    if not text:
        return set()
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            both = len(x & y)
            if both and 100 * both >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, len(s), root(d)) for d, s in sets)


def found(spark, docs, extra=()):
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *extra)
    return sorted(tuple(r) for r in jaccard.near_duplicates(rows).collect())


def corpus(seed, n, words=40):
    """Chains of edited copies, so that components are wider than single links, shared passages, short texts."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = " ".join(pick.choice(vocabulary) for _ in range(25))
    docs = []
    while len(docs) < n:
        text = [pick.choice(vocabulary) for _ in range(pick.choice([3, 5, 8, words, words * 3]))]
        for _ in range(pick.choice([1, 1, 2, 6])):
            docs.append(" ".join(text) + (f" {passage}" if pick.random() < 0.3 else ""))
            for _ in range(pick.choice([0, 1, 1, 2])):
                text[pick.randrange(len(text))] = pick.choice(vocabulary)
    return list(enumerate(docs[:n]))


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    docs = corpus(seed, 160)
    assert found(spark, docs) == brute(docs)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = [
        (0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO "), (5, "one two three four five"),
        (6, "ONE two three  four\x0bfive"), (7, "É é"), (8, "é é"), (9, long), (10, long + " y"), (11, None), (-5, "one two"),
    ]
    docs += [(20, "a b c d e f"), (20, "a b c d e f"), (21, "a b c d e f")]  # repeated rows
    got = found(spark, docs, ("'z' as n_shingles", "1 as hi", "2 as tokens"))
    want = brute([d for d in docs if d[0] != 20]) + [(20, 2, 20)] * 2
    want = [(d, n, 20 if d == 21 else c) for d, n, c in want]
    assert got == sorted(want)


def test_threshold_is_exact(spark):
    """6 of 8 shingles are linked, 5 of 7 are not."""
    base = [f"t{i}" for i in range(11)]  # 7 shingles
    at = (0, " ".join(base)), (1, " ".join(base[1:] + ["u"]))  # 6 shared, 8 in all
    below = (2, " ".join(f"v{i}" for i in range(10))), (3, " ".join([*(f"v{i}" for i in range(1, 10)), "u"]))
    assert found(spark, [*at, *below]) == [(0, 7, 0), (1, 7, 0), (2, 6, 2), (3, 6, 3)]


def test_large_group_of_near_copies(spark):
    pick = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    docs = []
    for i in range(300):
        text = list(base)
        for _ in range(pick.choice([0, 1, 2, 3])):
            text[pick.randrange(80)] = f"e{pick.randrange(10**6)}"
        docs.append((i, " ".join(text)))
    assert found(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_nothing_in_common(spark):
    docs = [(i, " ".join(f"d{i}w{j}" for j in range(12))) for i in range(5)]
    assert found(spark, docs) == [(i, 8, i) for i in range(5)]


def test_hash_of_a_word_does_not_depend_on_its_place():
    sets, stop = jaccard.shingle_sets(["a b c d e", "zz zz zz\na B c d E", None, "q"])
    assert stop.tolist() == [1, 5, 5, 6] and sets[0] in sets[1:5]


def test_components_of_a_path(spark):
    n = 40
    links = spark.createDataFrame([(i + 1, i) for i in range(n)], "a long, b long")
    assert {r["comp"] for r in jaccard.components(links).collect()} == {0}


def test_summary_misses_at_most_its_share():
    pick = np.random.default_rng(3)
    tokens = np.concatenate((np.repeat(np.arange(8, dtype=np.uint64), 400), pick.integers(100, 10_000, 4_000).astype(np.uint64)))
    pick.shuffle(tokens)
    summary = jaccard._Summary(40)
    for piece in np.array_split(tokens, 30):
        summary.add(piece)
    held = dict(zip(summary.tokens.tolist(), summary.times.tolist(), strict=True))
    assert len(held) <= 40 and summary.total == len(tokens)
    for token in range(8):
        true = int((tokens == token).sum())
        assert true - len(tokens) / 40 <= held[token] <= true


def test_a_passage_in_every_document_is_spread(spark):
    """No part is dealt more than its share of a shingle that all sets have, and no link is lost or made up by it."""
    passage = " ".join(f"p{i}" for i in range(7))
    docs = [(d, f"{text} {passage}" if text.count(" ") < 60 else text) for d, text in corpus(5, 240, words=12)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        _, hot = jaccard._classes_and_hot(rows, "doc_id", "text", 5)
        assert 3 <= len(hot.keys) <= jaccard.ROOM * 24
        dealt = jaccard._dealt(rows, "text", 5, 24, spark.sparkContext.broadcast(hot)).collect()
        sizes = dict.fromkeys(range(24), 0)
        for r in dealt:
            sizes[r["part"]] += len(r["tokens"]) // (4 if r["hot"] else 5)
        # The passage alone would put some 200 tokens, one a set, into one part for each of its shingles.
        assert max(sizes.values()) < 2.5 * sum(sizes.values()) / 24
        assert found(spark, docs) == brute(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
