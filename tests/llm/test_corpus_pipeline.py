"""The pipeline's stages, each against a brute-force version of its decision, and the registered queries."""

import sys
from pathlib import Path

import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers
from test_llm_decontaminate import brute as passages
from test_llm_jaccard import brute as groups
from test_llm_pii import plain

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from millrace.llm import bpe, registry
from millrace.session import materialize, scratch_path
from tools.check import TABLES, rows_of

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage kept, the input first."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(FOLDER)), "stage")
        out.append(docs)
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    assert kept[-1].columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]


def test_language_keeps_documents_with_letters(kept):
    want = sorted(d for d, t in texts(kept[0]) if t and any(c.isalpha() for c in t))
    assert sorted(d for d, _ in texts(kept[1])) == want


def test_one_of_each_group(kept):
    before = texts(kept[1])
    want = sorted(d for d, _, component in groups(before) if d == component)
    assert sorted(texts(kept[2])) == sorted(x for x in before if x[0] in set(want)) and len(want) < len(before)


def test_no_benchmark_passages(spark, kept):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = texts(kept[2])
    clean = {r[0] for r in passages(before, items) if not r[-1]}
    assert sorted(texts(kept[3])) == sorted(x for x in before if x[0] in clean)


def test_no_personal_data(kept):
    before, after = dict(texts(kept[3])), dict(texts(kept[4]))
    assert before.keys() == after.keys()
    for doc, text in before.items():
        assert not plain(after[doc])
        if not plain(text):
            assert after[doc] == text
    assert all(r["n_chars"] == len(r["text"]) for r in kept[4].collect())


def test_tokens(kept):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={})
    want = {d: encoding.encode_ordinary(t) for d, t in texts(kept[4])}
    got = {r["doc_id"]: list(r["token_ids"]) for r in kept[5].collect()}
    assert got == want and all(r["n_tokens"] == len(r["token_ids"]) for r in kept[5].collect())


def test_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "123", "en", "s", 3), (4, "some words of text", "en", "s", 18),
            (4, "some words of text", "en", "s", 18), (5, "Some WORDS of text", "en", "t", 18), (6, "mail me x@y.zz now", "en", "s", 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = scratch_path(spark, "odd")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == {4, 6}
    empty = scratch_path(spark, "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_ids_that_are_null_or_shared(spark):
    pairs = [
        (None, "no identifier and a text of its own"), (None, "another text without any identifier here"),
        (None, "a copy that also has an identifier"), (7, "A copy that also has an IDENTIFIER"),
        (None, "twice the same and never an identifier"), (None, "twice the same and never an identifier"),
        (8, "one of two texts that share an id"), (8, "second words entirely unlike those before them"),
        (9, "Repeated row in two spellings of it"), (9, "repeated row in two spellings of it"),
        (None, None), (None, " "), (-1, ""), (-1, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], schema)
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    want = [pairs[i] for i in (0, 1, 3, 4, 6, 7, 8, 10, 11, 13)]
    assert kept.columns == docs.columns and sorted(texts(kept), key=repr) == sorted(want, key=repr)

    folder = scratch_path(spark, "ids")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(ids, key=repr) == sorted([pairs[i][0] for i in (0, 1, 3, 4, 6, 7, 8)], key=repr)


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14)) and {*registry.QUERIES, "pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(registry.CHECKS))
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = queries()[name](spark, str(FOLDER))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.CHECKS)))
def test_query_has_a_row_per_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert queries()[name](spark, str(FOLDER)).count() == documents.count()
