"""Shards by histogram sort: near equal bytes, gapless slots, any distribution of keys."""

import random
import zlib

import pytest

from millrace.llm import shards


def check(spark, docs, **options):
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as slot", "1 as h", "2 as piece")
    rows = rows.drop("h", "piece")
    out = shards.shard_by_bytes(rows, **options)
    assert out.columns == ["doc_id", "text", "size", "shard", "slot"]
    got = out.collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted((d, t or "") for d, t in docs)
    by = {}
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by.items()}, got


def even(sizes, n, slack):
    share = sum(sizes.values()) / n
    assert len(sizes) == n and all(abs(s - share) <= slack for s in sizes.values()), sizes


def test_even_bytes(spark):
    pick = random.Random(1)
    docs = [(i, "é" * pick.randrange(0, 400)) for i in range(3000)]
    sizes, _ = check(spark, docs, shards=8)
    even(sizes, 8, 2 * 816)


def test_a_third_of_all_rows_is_one_text(spark):
    docs = [(i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    sizes, got = check(spark, docs, shards=10)
    even(sizes, 10, 120)
    own = sorted({r["shard"] for r in got if r["text"] == "the same text"})
    assert own == list(range(own[0], own[-1] + 1))  # the group lies together


def test_same_result_for_any_partitioning(spark):
    docs = [(i, f"text {i % 50}") for i in range(500)]
    a = check(spark, docs, shards=4)[1]
    b = check(spark, docs[::-1], shards=4)[1]
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in a} == {r["doc_id"]: (r["shard"], r["slot"]) for r in b}


@pytest.mark.parametrize(
    "docs",
    [
        [],
        [(1, None)],
        [(1, "x"), (2, None), (None, None), (None, "y")],
        [(1, "same")] * 50 + [(2, "other")],
        [(1, "a" * 100_000)] + [(i, "b") for i in range(2, 60)],
    ],
    ids=["empty", "one", "nulls", "repeated", "very long"],
)
def test_odd_tables(spark, docs):
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = shards.shard_by_bytes(rows, shards=5).collect()
    assert len(got) == len(docs) and all(0 <= r["shard"] < 5 for r in got)
    for shard in range(5):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_borders_are_the_nearest():
    bins = [shards.Bin((i, 0), (i, 1), 10, 1) for i in range(10)]
    pieces = shards.cut_pieces(bins, 3, 1, 100)
    assert [sum(len(p.bins) for p in pieces if p.shard == s) for s in range(3)] == [3, 4, 3]


def test_query_moves_whole_documents(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = shards.op4_histogram_shards(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["text_crc32"]) for r in df.collect()) == [(1, zlib.crc32(b"a")), (2, 0)]
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Window":
        plan = plan.children().head()
    moved = plan.children().head().output()
    assert "text" in [moved.apply(i).name() for i in range(moved.size())]
