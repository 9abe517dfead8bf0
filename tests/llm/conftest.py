import random

import pytest

WORDS = {
    "en": "the of and thing with from house water morning school letter window".split(),
    "de": "der und nicht schule wasser fenster straße über können möchte haus brief".split(),
    "fr": "le et dans école fenêtre où être maison lettre élève matin très".split(),
}


def sentence(rng, lang="en", n=40):
    return " ".join(rng.choice(WORDS[lang]) + str(rng.choice(["", "s", ""])) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture
def documents(spark):
    """Frame of (doc_id, text) with further columns whose names clash with results."""

    def make(rows):
        full = [(i, t, "en", "s", 0, 1.5, True, "x") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, shard string",
        )

    return make
