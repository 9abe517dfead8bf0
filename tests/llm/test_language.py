import pytest
from pyspark.sql import functions as F

from dwellspark.llm import langid
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def net(spark):
    import random

    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, rng.randint(5, 120)), lang) for i, lang in enumerate(["en", "de", "fr"] * 80)]
    rows += [(900, None, "en"), (901, "!!", "fr"), (902, "abc", None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_accuracy_over_whole_texts(spark, net, rng):
    rows = [(i, sentence(rng, lang, rng.randint(8, 3000)), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, true string")
    got = langid.identify(docs, net).collect()
    assert sum(r["true"] == r["lang_pred"] for r in got) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_the_end_of_a_long_text_counts(spark, net, rng):
    text = sentence(rng, "en", 200) + " " + sentence(rng, "de", 4000)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert langid.identify(docs, net).first()["lang_pred"] == "de"


def test_texts_without_letters_and_clashing_columns(documents, net):
    docs = documents([(1, None), (2, ""), (3, "12 !?"), (4, "the water"), (4, "the water"), (None, "der und nicht")])
    got = langid.identify(langid.filled(docs), net)
    assert got.columns.count("score") == 1
    rows = {(r["doc_id"], r["lang_pred"]) for r in got.collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= rows and got.count() == 6
    assert got.filter("lang_pred = 'und'").agg(F.max("score")).first()[0] == 0.0


def test_empty_tables(documents, net, spark):
    assert langid.identify(documents([]), net).count() == 0
    assert langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None
    assert langid.identify(documents([(1, "the")]), None).first()["lang_pred"] == "und"
