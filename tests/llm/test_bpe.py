import hashlib
import random

import numpy as np
import pytest

from dwellspark.llm import bpe, decontam, neardup, repeats
from dwellspark.llm.queries import VOCABULARY

ALPHABET = "abcdefghié'sT1 \n,.!!ÏİΣς́漢字\x1c "


@pytest.fixture(scope="module")
def own():
    return bpe.codec(VOCABULARY)


def direct(own, text):
    ids = own.tokenizer.encode(text, add_special_tokens=False).ids
    return ids, own.tokenizer.decode(ids, skip_special_tokens=False)


def texts():
    rng = random.Random(6)
    yield from ("", " ", "don't o'clock's", "<|endoftext|>", "a<|startoftext|>b <|endof text|>", "x" * 3000, "é" * 50)
    for _ in range(150):
        yield "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 300)))
        yield "".join(rng.choice("thereandoftionxqz") for _ in range(rng.randint(1, 800)))


def test_words_and_decoding_equal_the_tokenizer(own):
    for text in texts():
        ids, decoded = direct(own, text)
        assert own.ids(text) == np.array(ids, "<u4").tobytes()
        assert own.decode(own.ids(text)) == decoded


def test_words_are_forgotten_without_loss(own, monkeypatch):
    # Room for a few words; then for nothing at all.
    for room in (6 * bpe.ENTRY, 0):
        monkeypatch.setattr(bpe, "REMEMBERED", room)
        fresh = bpe.Codec(VOCABULARY)
        for text in ("the cat sat", "the dog ran off", "the dog and one two three four five six", "the cat", "don't the don't", "q" * 500 + " the " + "q" * 500):
            assert fresh.ids(text) == np.array(direct(own, text)[0], "<u4").tobytes()
            assert fresh.held <= room and max(map(len, [*fresh.words, *fresh.pieces]), default=0) <= bpe.LONG_WORD


@pytest.mark.parametrize("size", [7, 40, 150])
def test_concatenated_halves_equal_the_whole(own, size):
    for text in texts():
        leaves = [bpe.encode_range(own, text, i, min(len(text), i + size)) for i in range(0, max(len(text), 1), size)]
        assert bpe.concatenate(own, text, leaves).tolist() == direct(own, text)[0]


def test_table(own, documents, rng):
    long = " ".join(rng.choice(["Then", "thing,", "äöü", "x1y2"]) for _ in range(3000)) + "q" * 2000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "Some Text."), (4, "x" * 5000)]
    got = bpe.encode_documents(documents(rows), VOCABULARY, leaf_chars=500, with_values=True).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        ids, decoded = direct(own, text or "")
        r = by_id[doc_id]
        assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(ids), ids, decoded)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(documents([]), VOCABULARY).count() == 0


def test_pieces_are_encoded_in_batches(own, monkeypatch):
    fresh, sizes = bpe.Codec(VOCABULARY), []
    whole = fresh.tokenizer

    class Counted:
        def __getattr__(self, name):
            return getattr(whole, name)

        def encode_batch_fast(self, pieces, **options):
            sizes.append(len(pieces))
            return whole.encode_batch_fast(pieces, **options)

    fresh.tokenizer = Counted()
    monkeypatch.setattr(bpe, "BATCH", 3)
    text = "the dog and one two three don't four"
    assert fresh.ids(text) == np.array(direct(own, text)[0], "<u4").tobytes()
    assert len(sizes) > 1 and max(sizes) <= 3


def test_other_operators_give_up_the_codec():
    for run in (neardup._sketch(2, 8), repeats._anchors(400), decontam._search([], [])):
        first = bpe.codec(VOCABULARY)
        assert bpe.codec(VOCABULARY) is first
        list(run(iter([])))
        assert bpe.codec(VOCABULARY) is not first
