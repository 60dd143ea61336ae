"""Byte-level BPE against the public library, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.load_codec(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    pick = random.Random(1)
    alphabet = "abcdeéßñ çÆ  \n\t'sllre.,;!0123456789<|>漢字🙂‍\x00"
    out = ["", None, " ", "a", "<|endoftext|>", "it's we'll I'd", "a" * 3000, " " * 3000, "ab" * 2000, "🙂" * 500]
    out += ["".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 400))) for _ in range(300)]
    return out


def test_same_ids_as_the_library(codec, library):
    for text, ids in zip(texts(), codec.encode_batch(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == (library.encode_ordinary(text) if text else [])
        assert codec.decode(ids) == (text or "").encode()


def test_every_code_point(codec, library):
    for low in range(0, 0x110000, 0x4000):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(next(codec.encode_batch([text])), "<u4").tolist() == library.encode_ordinary(text)


def test_perfect_hash_is_minimal(codec):
    numbers = codec.hash.lookup(codec.keys)
    assert numbers.tolist() == list(range(len(codec.keys)))
    assert sorted(codec.hash.slot_key.tolist()) == list(range(len(codec.keys)))


def test_little_memory(codec, library, monkeypatch):
    """Forgetting pre-tokens changes nothing."""
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    fresh = bpe.Codec(bpe.read_ranks(bpe.VOCABULARY))
    for text, ids in zip(texts(), fresh.encode_batch(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == (library.encode_ordinary(text) if text else [])


def test_long_texts_go_block_by_block(codec, monkeypatch):
    whole = list(codec.encode_batch(texts()))
    monkeypatch.setattr(bpe, "_LONG", 5)
    monkeypatch.setattr(bpe, "_BLOCK", 3)
    assert list(codec.encode_batch(texts())) == whole


def words():
    pick = random.Random(2)
    return ["".join(pick.choice("abcdeéñ漢字ß") for _ in range(pick.randrange(2, 90))) for _ in range(3000)]


def test_short_words_are_merged_together(codec, library, monkeypatch):
    """New words of several texts cost a few calls, not one each; only long ones are merged alone."""
    fresh, alone, together = bpe.Codec(bpe.read_ranks(bpe.VOCABULARY)), [], []
    one, many = fresh._merged, fresh.rows.merge
    monkeypatch.setattr(fresh, "_merged", lambda piece: alone.append(piece) or one(piece))
    monkeypatch.setattr(fresh.rows, "merge", lambda pieces: together.append(len(pieces)) or many(pieces))
    texts = [" ".join(words()[at : at + 10]) for at in range(0, 3000, 10)]
    for text, ids in zip(texts, fresh.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert min(map(len, alone)) > 64
    assert sum(together) > 1000 and len(together) <= 3


def test_rows_and_heap_agree(codec):
    for size in (1, 2, 700):
        pieces = [w.encode() for w in words()[:size]] + [b"aaaa", b"\xff\x00", b" ", b"a"]
        assert [np.frombuffer(i, "<u4").tolist() for i in codec.rows.merge(pieces)] == [codec._merged(p) for p in pieces]


def test_later_merge_with_a_lower_rank():
    """A pair that a merge makes can come before pairs that were there: ranks need not grow with length."""
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"abc": 0, b"ab": 1, b"bc": 300, b"abcabc": 301, b"ca": 2}
    made = bpe.Codec(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabc", "bcabca", "cabcab", "ababcc", "abcabcabc", "a"):
        assert np.frombuffer(next(made.encode_batch([text])), "<u4").tolist() == library.encode_ordinary(text)


def test_operators(spark, library):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    rows = rows.selectExpr("*", "'x' as token_ids", "0 as n_tokens", "1 as decoded")
    encoded = bpe.encode(rows, bpe.VOCABULARY)
    assert encoded.columns == ["doc_id", "text", "n_tokens", "decoded", "token_ids"]
    back = bpe.decode(encoded, bpe.VOCABULARY).collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)
    assert all(r["token_ids"] == (library.encode_ordinary(r["text"]) if r["text"] else []) for r in back)
    for r in bpe.digests(rows, bpe.VOCABULARY, keep=["text"]).collect():
        ids = library.encode_ordinary(r["text"]) if r["text"] else []
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(rows, bpe.VOCABULARY).count() == 0


def test_vocabulary_without_single_bytes():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Codec({b"a": 0})
