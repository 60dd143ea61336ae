"""Personal data: base forms against plain regular expressions, discovered ones in planted contexts."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (
                True if kind == 0
                else all(int(p) <= 255 for p in m.group().split(".")) if kind == 1
                else 13 <= len(digits) <= 19 and luhn(digits) if kind == 2
                else 9 <= len(digits) <= 15
            )
            if ok:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1290.@+-() é%\n_4", max_size=40))
def test_base_forms_on_any_text(text):
    assert pii.base_spans(text) == plain(text)


def test_base_forms_on_likely_texts():
    pick = random.Random(2)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111112",
             "+1 (269) 555-3296", "+12", "000.0000.1.1", "5500-0000-0000-0004", "é", " ", ".", "-", "+", "9" * 30]
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(1, 7)))
        assert pii.base_spans(text) == plain(text)


def test_very_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "+1" * 100_000, "1." * 200_000, "1 " * 200_000, "a." * 200_000 + "@"):
        pii.loose_spans(text, pii.base_spans(text))


def planted():
    """Phones with their plus sign teach the context; some without it stand in the same one."""
    docs = [(i, f"Text {i} says please call me at +1 (555) 010-{1000 + i} today, thanks. Word{i}") for i in range(8)]
    docs += [(100, "Now call me at 555-010-7777 today or so"), (101, "nothing to see in 1999-2004 or 5551234 there")]
    docs += [(102, None), (103, ""), (104, "é mail a@b.co and 10.0.0.1 or 4111 1111 1111 1111"), (104, "é mail a@b.co and 10.0.0.1 or 4111 1111 1111 1111")]
    docs += [(105, "Now call me at 555-010-7777 today or so"), (106, "z " * 50_000 + "x@y.zz")]
    return docs


def test_contexts_discover(spark):
    rows = spark.createDataFrame(planted(), "doc_id long, text string").selectExpr("*", "1 as base", "'s' as spans")
    found = {r["doc_id"]: r for r in pii.find(rows).collect()}
    assert len(found) == len({d for d, _ in planted()})
    assert found[100]["spans"] == found[105]["spans"] == "phone:15:27" and found[100]["n_phone"] == 0
    assert found[101]["spans"] == "" and found[102]["spans"] == "" and found[103]["base"] == ""
    assert found[104]["base"] == found[104]["spans"] == "email:7:13,ip:18:26,card:30:49"
    assert found[106]["base"] == "email:100000:100006"
    for doc, text in planted():
        spans = plain(text or "")
        assert [found[doc][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]


def test_rare_contexts_do_not(spark):
    docs = [(i, f"call me at +1 (555) 010-{1000 + i} today") for i in range(2)] + [(9, "call me at 555-010-7777 today")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in pii.find(rows).collect()}[9] == ""


def test_scores(spark):
    edges = [(3, "p", f"v{i}", i < 4) for i in range(5)] + [(3, "q", "v4", False), (3, "q", "w", False)]
    edges = spark.createDataFrame(edges, "kind int, pattern string, value string, seed boolean")
    first = {r["pattern"]: r["score"] for r in pii.score_patterns(edges, rounds=1).collect()}
    second = {r["pattern"]: r["score"] for r in pii.score_patterns(edges, rounds=2).collect()}
    assert first == {"p": 0.8} and abs(second["p"] - (4 + 0.8) / 5) < 1e-9


def test_discovered_values_are_seeds(spark):
    docs = [(i, f"please call me at +1 (555) 010-{1000 + i} today") for i in range(8)]
    steps = ["call me at {} today", "my fax line {} rings", "old pager code {} beeps", "last desk number {} works"]
    for k in range(3):  # each step is reached through the values of the one before
        docs += [(100 + 10 * k + i, f"Word {steps[k].format(f'555-01{k}-700{i}')} and {steps[k + 1].format(f'555-01{k}-700{i}')}") for i in range(4)]
    docs += [(200, "so the last desk number 555-099-1234 works"), (201, "an order of lot 555-099-1234 pieces")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[200] == "phone:24:36" and found[201] == ""
    assert all(found[100 + 10 * k + i].count("phone") == 2 for k in range(3) for i in range(4))


def test_contexts_of_whole_words_in_any_distance():
    long, blanks = "w" * 70, " " * 300
    text = f"{long} {long}{blanks}5551234567 . {blanks}{long}7 x"
    at = text.index("555")
    assert pii.patterns_at(text, at, at + 10) == [f"{long} {long} _", f"{long} _ {long}0"]
    glued = "5551234567," * 20_000
    assert max(len(p) for s in pii.loose_spans(glued, []) for p in pii.patterns_at(glued, *s[1:])) < 200


def test_digits_of_a_secret_are_no_number():
    text = 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" 63815530x x63815530 63815531é é63815532 (63815533)'
    assert [(k, text[a:b]) for k, a, b in pii.loose_spans(text, [])] == [(3, "63815533")]


def test_a_place_has_one_kind():
    text = "call 555 123 4567 or 1.2.3.4.567 or me@10.20.30.40"
    assert [(k, text[a:b]) for k, a, b in pii.loose_spans(text, [])] == [(3, "555 123 4567"), (1, "1.2.3.4.567"), (0, "me@10.20.30.40")]


def test_loose_addresses_are_whole():
    local, domain = "é" * 100, "host" * 30
    text = f"to {local}@{domain}, a@b@c"
    assert [text[b:e] for _, b, e in pii.loose_spans(text, [])] == [f"{local}@{domain}", "a@b"]


def test_redaction(spark):
    rows = spark.createDataFrame(planted(), "doc_id long, text string").selectExpr("*", "doc_id as `_high2`", "'x' as kind")
    out = pii.redact(rows)
    assert out.columns == rows.columns and out.count() == rows.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[100] == "Now call me at [PHONE] today or so" and text[102] is None and text[103] == ""
    assert text[104] == "é mail [EMAIL] and [IP] or [CARD]" and text[101] == planted()[9][1]


def test_overlapping_spans_become_one():
    text = "+4111 1111 1111 1111 x"
    assert pii._redacted(text, [(2, 1, 20), (3, 0, 20)]) == "[PHONE] x"


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(rows).count() == 0 and pii.redact(rows).count() == 0
