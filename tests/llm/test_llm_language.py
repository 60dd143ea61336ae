"""Language identification: held-out accuracy and defined results for odd rows."""

import random

import pytest

from millrace.llm import language

WORDS = {
    "aa": "thing house river under stone water light which about other".split(),
    "bb": "été rivière maison pierre lumière dessous quelle autre près eau".split(),
    "cc": "fluß straße über größe stein wasser licht welche andere nähe".split(),
}


def sample(lang, n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS[lang]) + pick.choice(["", "s", "e"]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, sample(lang, 20, f"{lang}{i}"), lang) for lang in WORDS for i in range(40)]
    rows += [(900, None, "aa"), (901, "x", None), (902, "", "bb"), (903, "12 34", "cc")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def predicted(spark, model, texts, extra=""):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    if extra:
        rows = rows.selectExpr("*", extra)
    return language.identify(rows, model)


def test_held_out_accuracy(spark, model):
    want = [lang for lang in WORDS for _ in range(30)]
    texts = [sample(lang, 6, f"new{i}") for i, lang in enumerate(want)]
    got = [r["lang_pred"] for r in predicted(spark, model, texts).orderBy("id").collect()]
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 88


def test_odd_texts(spark, model):
    long = sample("cc", 60_000, "long")
    texts = [None, "", " \n", "123 !!", long, long, "x", "\x00", "ß"]
    rows = predicted(spark, model, texts).orderBy("id").collect()
    assert [(r["lang_pred"], r["score"]) for r in rows[:4]] == [("und", 0.0)] * 4
    assert rows[4]["lang_pred"] == rows[5]["lang_pred"] == "cc" and rows[4]["score"] == rows[5]["score"]
    assert rows[6]["lang_pred"] in WORDS and rows[7]["lang_pred"] == "und" and rows[8]["lang_pred"] in WORDS
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_prediction_depends_on_the_text_alone(spark, model):
    rows = predicted(spark, model, [sample("aa", 9, 1)] * 3, "id as lang").collect()
    assert len({(r["lang_pred"], r["score"]) for r in rows}) == 1


def test_clashing_columns_are_replaced(spark, model):
    out = predicted(spark, model, [sample("bb", 9, 1)], "7 as score")
    assert out.columns == ["id", "text", "lang_pred", "score"] and out.first()["score"] <= 1


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.fit(empty)
    assert language.identify(empty, model).count() == 0
    assert predicted(spark, model, ["some text"]).first()["lang_pred"] == "und"


def test_many_copies_of_a_text_do_not_fill_the_sample(spark):
    rows = [(i, "copy of one text", "aa") for i in range(300)]
    rows += [(1000 + i, sample("aa", 8, i), "aa") for i in range(30)] + [(2000 + i, sample("cc", 8, i), "cc") for i in range(30)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    assert predicted(spark, model, [sample("cc", 9, "q")]).first()["lang_pred"] == "cc"


def test_kernel_equals_counted_ngrams(spark):
    """The folded product gives the same kernel as sets of n-grams."""
    a, b = language._present("Ab c"), language._present("ab")
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    assert len(set(a) & set(b)) == len(grams(" ab c ") & grams(" ab "))
    assert len(a) == len(grams(" ab c "))
