import pytest

from dwellspark.llm import toxicity
from tests.llm.conftest import sentence

BAD = ["idiot", "moron", "clown", "worthless"]


@pytest.fixture(scope="module")
def fitted(spark):
    import random

    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        words = sentence(rng, "en", rng.randint(5, 60)).split()
        toxic = i % 3 == 0
        for _ in range(2 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.character_model(docs)
    return model, toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), model)


def test_counts_cover_all_documents(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, None)], "doc_id long, text string")
    model = toxicity.character_model(docs)
    assert model[0, 1, 2] > model[0, 1, 3]


@pytest.mark.parametrize(
    "text,restored",
    [
        ("you 1diot now", "you idiot now"), ("m0r0n", "moron"), ("c l o w n !", "clown !"), ("i.d.i.o.t", "idiot"),
        ("idiooot,", "idiot"), ("wat3r and sch00l", "water and school"), ("The House", "the house"), ("a b", "a b"), ("", ""), ("42 3.14", "42 3.14"),
    ],
)
def test_restoring(fitted, text, restored):
    assert toxicity.Restorer(fitted[0]).text(text) == restored


def test_scores_see_through_disguise_and_spare_clean_texts(fitted, documents, rng):
    clean = [(i, sentence(rng, "en", 50)) for i in range(20)]
    plain = [(100 + i, sentence(rng, "en", 30) + f" {w} " + sentence(rng, "en", 30)) for i, w in enumerate(BAD)]
    masked = [(200 + i, f"the house {w} of water") for i, w in enumerate(["m0r0n", "i d i o t", "cl0wnnn", "w.o.r.t.h.l.e.s.s"])]
    far = [(300, sentence(rng, "en", 20_000) + " idiot")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents(clean + plain + masked + far), fitted[1]).collect()}
    assert all(got[i] < 0.5 for i, _ in clean)
    assert all(got[i] >= 0.5 for i, _ in plain + masked + far)


def test_edges(fitted, documents, spark):
    got = toxicity.score_documents(documents([(1, None), (2, ""), (3, "idiot moron"), (3, "idiot moron"), (None, "x")]), fitted[1])
    rows = got.collect()
    assert got.columns == ["doc_id", "score"] and len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(documents([]), fitted[1]).count() == 0
    none = toxicity.fit(documents([(1, "a")]), spark.createDataFrame([], "doc_id long, toxic int"), fitted[0])
    assert toxicity.score_documents(documents([(1, "a")]), none).first()["score"] < 0.5
    assert toxicity.character_model(documents([])).shape == (28, 28, 28)


@pytest.mark.parametrize(
    "text,restored",
    [("a moroon", "a moron"), ("iddiioott", "idiot"), ("wwoorthless, man", "worthless, man"), ("1d107", "idiot"), ("school letter", "school letter"), ("4x400 100m", "4x400 100m")],
)
def test_restoring_pairs_closing_signs_and_mostly_signs(fitted, text, restored):
    import numpy as np

    if restored != text:
        data = np.frombuffer(text.encode(), np.uint8)
        assert toxicity.disguised(data, np.array([0, len(data)]))[0]
    assert toxicity.Restorer(fitted[0]).text(text) == restored


def test_closing_sign(fitted):
    assert toxicity.Restorer(fitted[0]).text("idio+") == "idiot"
