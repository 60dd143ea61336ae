"""The trie of conversations against one built with dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import trie
from millrace.llm.rangemin import RangeMin


def brute(conversations):
    """Rows of the trie of {conv: [(role, text), ...]}."""
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = own + sum(saved[c] for c in below)
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(conversations[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def grouped(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            out.setdefault(conv, []).append((role or "", text or ""))
    return out


def table(seed, conversations=120, most=9, letters="ab"):
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        key = pick.choice([conv, conv * 100, -conv, conv * 7919])
        if any(r[0] == key for r in rows):
            continue
        for turn in range(pick.randrange(1, most)):
            rows.append((key, turn, pick.choice(["user", "user", None]), pick.choice([*letters, None])))
    # Copies of one conversation, long ones too.
    rows += [(10**6 + c, t, "user", "a") for c in range(40) for t in range(7)]
    rows += [(2 * 10**6 + c, t, "user", "aé🙂"[: 1 + t % 3]) for c in range(4) for t in range(23 + c % 2)]
    rows += [(5, None, "user", "x"), (5, None, "user", "x"), (5, 3, None, None), (None, 1, "user", "lost")]
    pick.shuffle(rows)
    return rows


DDL = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("segment,block", [(256, 1 << 15), (2, 3), (3, 1), (7, 10), (1, 4)])
def test_trie(spark, segment, block):
    data = table(segment)
    df = spark.createDataFrame(data, DDL).selectExpr("*", "1 as depth", "'x' as conv", "2 as seg").repartition(3)
    turns = trie.materialize(trie.turn_digests(df), "digests")
    got = trie.trie(turns, trie.members_of(turns), segment, block)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=repr) == brute(grouped(data))


def test_general_form(spark):
    data = table(11)
    got = trie.conversation_trie(spark.createDataFrame(data, DDL).toDF("c", "t", "r", "x"), "c", "t", "r", "x")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(grouped(data))


@pytest.mark.parametrize("segment,block", [(256, 1 << 15), (2, 3)])
def test_openings(spark, segment, block):
    data = table(21, 200, 4)
    own = grouped(data)
    conversations = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100 if conv >= 0 else -(abs(conv) % 100))
        conversations[conv] = own.get(base, [])[:h] + turns[h:]
    assert any(not turns for turns in conversations.values())
    turns = trie.materialize(trie.turn_digests(spark.createDataFrame(data, DDL)), "digests")
    got = trie.trie(*trie.shared_openings(turns), segment, block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(conversations)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], DDL)
    assert trie.conversation_trie(empty).count() == 0
    one = spark.createDataFrame([(7, 0, "user", "hé"), (None, 0, "user", "x")], DDL)
    assert sorted(map(tuple, trie.conversation_trie(one).collect()), key=repr) == brute({7: [("user", "hé")]})


def test_long_text_and_hot_opening(spark):
    text = "lang " * 200_000
    data = [(c, t, "user", text if t == 0 else f"{c % 3}") for c in range(30) for t in range(2)]
    got = trie.conversation_trie(spark.createDataFrame(data, DDL))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(grouped(data))


def test_range_minima():
    pick = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        values = pick.integers(0, 6, n)
        minima = RangeMin(values)
        a, b = np.sort(pick.integers(0, n, (2, 200)), axis=0)
        assert minima.least(a, b).tolist() == [values[i : j + 1].min() for i, j in zip(a, b, strict=True)]
        bound = pick.integers(0, 7, 200)
        for place, limit, r, l in zip(a, bound, minima.right(a, bound), minima.left(a, bound), strict=True):  # noqa: E741
            right, left = place, place
            while right + 1 < n and values[right + 1] >= limit:
                right += 1
            while left >= 1 and values[left] >= limit:
                left -= 1
            assert (r, l) == (right, left)
