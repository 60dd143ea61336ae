"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from millrace.llm import runs


def brute(words, least, power):
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def listed(found):
    return list(zip(found.start.tolist(), found.length.tolist(), found.period.tolist(), strict=True))


def texts():
    pick = random.Random(2)
    out = ["", None, " ", "a", "a a", "a " * 50, "ab " * 200, "a b " * 40 + "a", "\t\x0b\x0c\r\n", "x y " * 30, "  " * 40]
    for _ in range(250):
        letters = "ab" if pick.random() < 0.5 else "abc"
        out.append(" ".join(pick.choice(letters) for _ in range(pick.randrange(1, 90))))
    for _ in range(60):
        base = [pick.choice("abcd") for _ in range(pick.randrange(1, 9))]
        middle = base * pick.randrange(1, 12) + base[: pick.randrange(len(base))]
        out.append(" ".join([pick.choice("abcd") for _ in range(5)] + middle * pick.randrange(1, 4) + [pick.choice("abcd") for _ in range(5)]))
    # Fibonacci words are full of runs.
    a, b = "a", "a b"
    for _ in range(8):
        a, b = b, f"{b} {a}"
    return [*out, b, b]


@pytest.mark.parametrize("least,power", [(24, 3), (2, 2), (5, 2), (1, 4)])
def test_runs(least, power):
    for text, found in zip(texts(), runs.runs_of(texts(), least, power), strict=True):
        assert found.words == [w.encode() for w in (text or "").replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
        assert listed(found) == brute(found.words, least, power), text


def test_alone_as_together():
    """The texts of a batch do not touch each other, and small slices change nothing."""
    for text, found in zip(texts(), runs.runs_of(texts(), 2, 2), strict=True):
        assert listed(next(runs.runs_of([text], 2, 2))) == listed(found)


def test_small_slices(monkeypatch):
    whole = [listed(f) for f in runs.runs_of(texts(), 2, 2)]
    monkeypatch.setattr(runs, "_CELLS", 16)
    assert [listed(f) for f in runs.runs_of(texts(), 2, 2)] == whole


def test_long_run():
    found = next(runs.runs_of(["a b c " * 100_000 + "d"]))
    assert listed(found) == [(0, 300_000, 3)] and found.collapsed() == b"a b c d"


def test_operators(spark):
    rows = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").selectExpr("*", "'x' as start", "1 as collapsed")
    expected = {i: brute(f.words, 24, 3) for i, f in enumerate(runs.runs_of(texts()))}
    got = {i: [] for i in expected}
    for r in runs.find_runs(rows).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["period"]))
    assert got == expected
    for r in runs.collapse_runs(rows).collect():
        words = (r["text"] or "").encode().split()
        gone = {i for s, n, q in expected[r["doc_id"]] for i in range(s + q, s + n)}
        assert r["collapsed"].encode() == b" ".join(w for i, w in enumerate(words) if i not in gone)
    assert runs.run_digests(rows.limit(0)).count() == 0
    with pytest.raises(ValueError, match="square"):
        runs.find_runs(rows, power=1)


def test_query(spark):
    pick = random.Random(4)
    data = [(pick.randrange(10**6), t) for t in texts()] + [(None, "a " * 30), (None, None)]
    rows = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(map(tuple, runs.run_digests(runs.made_periodic(rows), keep=["doc_id"]).collect()), key=repr)
    expected = []
    for doc, text in data:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = brute(words, 24, 3)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        expected.append((doc, len(found), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(expected, key=repr)
