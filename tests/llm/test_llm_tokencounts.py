"""Prefix token counts against the public library, which encodes every prefix anew."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import tokencounts


@pytest.fixture(scope="module")
def counter():
    return tokencounts.load_counter(tokencounts.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokencounts.VOCABULARY)


def texts():
    pick = random.Random(3)
    alphabet = "abcdeéßñ çÆ  \n\t\r'sllretv.,;!0123456789<|>漢字🙂‍\x00\x85\xa0　\x1c"
    words = ["the", " there", "'re", "'ve", "'ll", "'s", " ", "  ", "\n", "\n\n ", "<|endoftext|>", "<|endof", "!", "12", "été", " 漢字", "nationally"]
    out = ["", None, " ", "a", "<|endoftext|>", "it's we'll I'd they're you've", "a" * 300, " " * 200, "ab" * 100, "🙂" * 50]
    out += ["x <|endoftext|> <|endoftext|>", "hm!<|endoftext|>", "  <|endoftext|>y", "<|endoftext|><|endoftext|", "'<|endoftext|>'re"]
    out += ["".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 80))) for _ in range(150)]
    out += ["".join(pick.choice(words) for _ in range(pick.randrange(1, 25))) for _ in range(150)]
    return out


def every_prefix(library, text):
    cut = [(text or "")[:i] for i in range(len(text or "") + 1)]
    return [len(e.ids) for e in library.encode_batch(cut, add_special_tokens=False)]


def test_every_prefix(counter, library):
    for text in texts():
        assert np.concatenate(list(counter.counts(text))).tolist() == every_prefix(library, text), repr(text)


def test_every_code_point(counter, library):
    for low in range(0, 0x110000, 0x4000):
        text = "".join(f"a{chr(c)} " for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000)
        assert int(list(counter.counts(text))[-1][-1]) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_token_of_the_vocabulary(counter, library):
    """Tokens side by side, so that many pairs are tried."""
    known = [t.decode() for t in counter.vocabulary.tokens if t and t.decode("utf-8", "ignore").encode() == t]
    pick = random.Random(5)
    cut = ["".join(pick.sample(known, 6)) for _ in range(3000)]
    for text, encoded in zip(cut, library.encode_batch(cut, add_special_tokens=False), strict=True):
        assert int(list(counter.counts(text))[-1][-1]) == len(encoded.ids), repr(text)


def test_little_memory_and_small_pieces(library, monkeypatch):
    """Forgetting and cutting change nothing."""
    monkeypatch.setattr(tokencounts, "REMEMBERED_BYTES", 1000)
    monkeypatch.setattr(tokencounts, "REMEMBERED_PAIRS", 7)
    monkeypatch.setattr(tokencounts, "PIECE", 5)
    small = tokencounts.PrefixCounter(tokencounts.read_vocabulary(tokencounts.VOCABULARY))
    for text in texts()[:20] + texts()[20::25]:
        assert np.concatenate(list(small.counts(text))).tolist() == every_prefix(library, text), repr(text)


def test_questions(spark, library):
    rows = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").selectExpr("*", "'x' as token_counts", "7 as n_tokens")
    counted = tokencounts.prefix_counts(rows)
    assert counted.columns == ["doc_id", "text", "n_tokens", "token_counts"]
    asked = counted.select(
        "text",
        tokencounts.tokens_of_prefix(F.col("token_counts"), 3).alias("three"),
        tokencounts.fitting_prefix(F.col("token_counts"), 4).alias("fits"),
        tokencounts.fitting_prefix(F.col("token_counts"), -1).alias("none"),
        tokencounts.truncated(F.col("text"), F.col("token_counts"), 4).alias("cut"),
    )
    for r in asked.collect():
        counts = every_prefix(library, r["text"])
        fits = max(i for i, n in enumerate(counts) if n <= 4)
        assert (r["three"], r["fits"], r["none"]) == (counts[min(3, len(counts) - 1)], fits, -1)
        assert r["cut"] == (None if r["text"] is None else r["text"][:fits])
    told = {r["doc_id"]: r for r in tokencounts.budgets(rows, 4).collect()}
    for number, text in enumerate(texts()):
        counts = every_prefix(library, text)
        assert told[number]["n_tokens"] == counts[-1]
        assert told[number]["fitting"] == max(i for i, n in enumerate(counts) if n <= 4)
        assert "text" in told[number]


def test_empty_table_and_long_text(spark, library):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert tokencounts.budgets(rows).count() == 0
    text = "Ein langer Satz, der oft vorkommt. " * 30000
    long = spark.createDataFrame([(None, text), (None, text)], "doc_id long, text string")
    expected = len(library.encode(text, add_special_tokens=False).ids)
    assert [r["n_tokens"] for r in tokencounts.budgets(long).collect()] == [expected] * 2


def test_query(spark, library):
    from millrace.llm.common import table

    folder = "/root/testdata/sf0.001"
    texts_by_id = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    for r in tokencounts.op12_token_counts(spark, folder).collect():
        text = texts_by_id[r["doc_id"]] or ""
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), expected, expected > 1024)
