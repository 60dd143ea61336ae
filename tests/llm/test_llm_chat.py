"""Tool-call linking: links, order, validation and canonical JSON."""

import json
import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import chat

SCHEMAS = {
    "add": {"properties": {"a": "integer", "b": "number", "note": "string", "o": "object", "l": "array", "t": "boolean"}, "required": ["a"]},
    "none": {},
}


def call(*calls, **more):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c, strict=False)) for c in calls], **more})


def answer(call_id, content="ok"):
    return json.dumps({"tool_call_id": call_id, "content": content})


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as row", "2 as json", "3 as conv")
    return sorted(chat.format_chat(df, SCHEMAS).collect(), key=lambda r: (repr(r["conv_id"]), r["position"]))


def test_links_and_order(spark):
    rows = [
        (1, 0, "tool", answer("x")),  # before its call
        (1, 1, "user", "hello"),
        (1, 2, "assistant", call(("x", "add", {"a": 1}, ["y"]), ("y", "none", {}), content="both")),
        (1, 3, "tool", answer("y")),
        (1, 4, "assistant", call(("x", "none", {}))),  # the identifier is taken
        (1, 5, "tool", answer("nobody")),
        (2, 0, "assistant", call(("x", "none", {}))),
    ]
    got = formatted(spark, rows)
    order = [(r["turn"], r["part"], r["kind"], r["call_id"], r["linked"]) for r in got if r["conv_id"] == 1]
    assert order == [
        (1, 0, "message", None, None), (2, 1, "call", "y", True), (2, 2, "message", None, None), (2, 0, "call", "x", True),
        (0, 0, "result", "x", True), (3, 0, "result", "y", True), (4, 0, "call", "x", False), (5, 0, "result", "nobody", False),
    ]
    assert [r["position"] for r in got] == [*range(8), 0]
    assert [r["linked"] for r in got if r["conv_id"] == 2] == [False]


def test_arguments_against_schemas(spark):
    cases = [
        ({"a": 1}, []), ({}, ["a: missing"]), ({"a": None}, ["a: missing"]), ({"a": "1"}, ["a: not of type integer"]),
        ({"a": 1, "b": 1.5, "note": "n", "o": {"x": []}, "l": [1], "t": False}, []), ({"a": 1.5}, ["a: not of type integer"]),
        ({"a": 1, "zz": 0}, ["zz: unknown"]), ({"o": 1, "l": {}, "t": 0, "b": "x", "note": 3}, [
            "a: missing", "b: not of type number", "l: not of type array", "note: not of type string", "o: not of type object", "t: not of type boolean"]),
        ([1], ["arguments: not an object"]), (None, ["arguments: not an object"]),
    ]
    rows = [(i, 0, "assistant", call(("c", "add", args))) for i, (args, _) in enumerate(cases)]
    rows += [(100, 0, "assistant", call(("c", "what", {}))), (101, 0, "assistant", call(("c", "none", {"q": 1})))]
    got = {r["conv_id"]: r for r in formatted(spark, rows)}
    assert [list(got[i]["errors"]) for i in range(len(cases))] == [e for _, e in cases]
    assert got[100]["errors"] == ["unknown tool"] and got[101]["errors"] == ["q: unknown"] and got[0]["valid"] is False


def test_canonical_json(spark):
    rows = [
        (1, 0, "assistant", '{ "tool_calls" : [ {"name":"add", "id":"i", "arguments": {"note" : "é\\u00e9\\n/", "a" : 1 }} ] }'),
        (1, 1, "tool", answer("i", 'say "é"')),
    ]
    first, second = (r["json"] for r in formatted(spark, rows))
    assert first == json.dumps(
        {"arguments": {"a": 1, "note": "éé\n/"}, "call": "i", "conversation": 1, "kind": "call", "name": "add", "role": "assistant", "turn": 0},
        ensure_ascii=False, sort_keys=True, separators=(",", ":"),
    )
    assert json.loads(second) == {"call": "i", "content": 'say "é"', "conversation": 1, "kind": "result", "role": "tool", "turn": 1}


def test_odd_rows(spark):
    long = "x" * 200_000
    rows = [
        (1, 0, "user", None), (1, 1, "user", ""), (1, None, "assistant", "{broken"), (1, 2, "assistant", "{}"), (1, 3, "tool", "{}"),
        (1, 4, None, "text"), (None, 0, "user", "no conversation"), (1, 1, "user", ""), (1, 5, "assistant", '{"tool_calls": 5}'),
        (1, 6, "assistant", '{"tool_calls": []}'), (1, 7, "user", long), (1, 8, "user", call(("x", "none", {}))),
        (1, 9, "assistant", call((None, "none", {}))),
    ]
    got = formatted(spark, rows)
    own = [r for r in got if r["conv_id"] == 1]
    assert [r["position"] for r in own] == list(range(len(own)))
    assert {r["turn"] for r in own} == {None, 0, 1, 2, 3, 4, 5, 7, 8, 9}  # an empty list of calls makes no event
    assert all(r["kind"] == "message" and r["linked"] is None for r in own if r["turn"] != 9)
    assert [r["linked"] for r in own if r["turn"] == 9] == [False]
    assert [r["conv_id"] for r in got].count(None) == 1


def test_calls_that_wait_for_each_other(spark):
    rows = [(1, 0, "assistant", call(("a", "none", {}, ["b"]), ("b", "none", {}, ["a"]), ("c", "none", {}, ["c"]))), (1, 1, "user", "after")]
    got = formatted(spark, rows)
    assert len(got) == 4 and all("order: waits for itself" in r["errors"] for r in got if r["kind"] == "call")
    assert got[-1]["kind"] == "message"


def test_chains_of_any_depth(spark):
    n = 300
    chain = [(f"c{i}", "none", {}, [f"c{i + 1}"]) for i in range(n)] + [(f"c{n}", "none", {})]
    rows = [(1, 0, "assistant", call(*chain)), (1, 1, "user", "after")]
    rows += [(2, i, "assistant", call(c)) for i, c in enumerate(chain)] + [(2, n + 1 + i, "tool", answer(f"c{i}")) for i in range(n + 1)]
    # Events that wait for a cycle of the same turn fail with it, those of a later turn come behind it anyway.
    rows += [(3, 0, "assistant", call(*chain, ("x", "none", {}, ["y"]), ("y", "none", {}, ["x"]), ("z", "none", {}, ["x", "c0"])))]
    rows += [(3, 1, "tool", answer("c0")), (3, 2, "tool", answer("x"))]
    got = formatted(spark, rows)
    back = [f"c{i}" for i in range(n, -1, -1)]
    assert [r["call_id"] for r in got if r["conv_id"] == 1] == [*back, None]
    assert [r["call_id"] for r in got if r["conv_id"] == 2 and r["kind"] == "call"] == back
    assert all(r["valid"] and not r["errors"] for r in got if r["conv_id"] == 2)
    third = [r for r in got if r["conv_id"] == 3]
    assert [r["call_id"] for r in third if r["errors"]] == ["x", "y", "z"] and [r["position"] for r in third] == list(range(len(third)))
    assert [r["call_id"] for r in third if r["call_id"][0] == "c" and r["kind"] == "call"] == back
    assert [(r["kind"], r["valid"]) for r in third[-2:]] == [("result", True)] * 2


def test_settled_as_rounds_do():
    pick = random.Random(3)
    for _ in range(200):
        start = {i: (pick.randrange(4), pick.randrange(3)) for i in range(12)}
        links = sorted({(pick.randrange(12), pick.randrange(12)) for _ in range(pick.choice([4, 10, 14]))})
        at = {i: (t, 0) for i, (t, _) in start.items()}
        for _ in range(400):
            key = {i: (*at[i], *start[i], i) for i in at}
            step = {}
            for u, v in links:
                if key[u] <= key[v]:
                    step[u] = max(step.get(u, (0, 0)), (at[v][0], at[v][1] + ((*start[u], u) <= (*start[v], v))))
            at.update(step)
        want = {i: (start[i][0], 0, True) if at[i][1] > 100 else (*at[i], False) for pair in links for i in pair}
        columns = [(u, *start[u], v, *start[v]) for u, v in links]
        table = pa.table(dict(zip(("row", "at", "part", "needs", "first_at", "first_part"), map(list, zip(*columns)))))
        assert {r["row"]: (r["at"], r["level"], r["cyclic"]) for r in chat._settled(table).to_pylist()} == want


def test_long_chain_is_settled_in_one_pass():
    n = 200_000
    own, need = list(range(n)), list(range(1, n + 1))
    table = pa.table({"row": own, "at": [0] * n, "part": own, "needs": need, "first_at": [0] * n, "first_part": need})
    begun = time.perf_counter()
    settled = chat._settled(table)
    assert settled.column("level").to_pylist() == list(range(n, -1, -1))
    assert time.perf_counter() - begun < 20  # by rounds it would be 20,000 million steps


def test_conversation_without_id(spark):
    rows = [(None, 1, "assistant", call(("x", "none", {}))), (None, 0, "tool", answer("x")), (None, 2, "user", "u"), (7, 0, "tool", answer("x"))]
    got = formatted(spark, rows)
    assert [(r["conv_id"], r["kind"], r["linked"], r["position"]) for r in got] == [
        (7, "result", False, 0), (None, "call", True, 0), (None, "result", True, 1), (None, "message", None, 2),
    ]


def test_large_conversation_is_split(spark):
    rows = spark.range(2000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "'t' as text")
    out = chat.format_chat(chat.as_tool_calls(rows), chat.REPLY)
    got = out.agg(F.count("*"), F.countDistinct("position"), F.max("position"), F.sum(F.col("valid").cast("int"))).first()
    assert tuple(got) == (2000, 2000, 1999, 2000)


def test_empty_table(spark):
    assert formatted(spark, []) == []
