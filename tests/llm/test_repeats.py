import hashlib
import random
import re
from collections import Counter

import pytest

from dwellspark.llm import repeats


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i if i is not None else -1, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def cases():
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, short = noise(700), noise(150)
    rows = [(i, noise(rng.randint(0, 900)) + passage[rng.randint(0, 300) : rng.randint(350, 700)] + noise(300)) for i in range(30)]
    rows += [(100 + i, short + noise(260)) for i in range(10)]
    base = noise(2500)
    for i in range(8):
        at = rng.randrange(2400)
        rows.append((200 + i, base[:at] + noise(rng.randint(0, 4)) + base[at + 2 :]))
    rows += [(300, "xy" * 500), (301, "z" * 399), (302, "z" * 399), (303, "z" * 400), (304, None), (305, ""), (306, "q" * 401)]
    rows += [(310, passage)] * 3 + [(311, "tiny")] * 2 + [(None, passage + "end"), (312, noise(399)), (313, base + base)]
    return rows


def test_against_brute_force(documents):
    rows = cases()
    got = repeats.repeat_digest(documents(rows)).collect()
    assert sorted((r[0] if r[0] is not None else -1, *tuple(r)[1:]) for r in got) == brute(rows, 400)


def test_hot_grams_are_cut_into_parts_without_loss(documents, monkeypatch):
    monkeypatch.setattr(repeats, "LEAST_HOT", 3)
    monkeypatch.setattr(repeats, "SHARES", 50)
    rows = cases()
    got = repeats.repeat_digest(documents(rows)).collect()
    assert sorted((r[0] if r[0] is not None else -1, *tuple(r)[1:]) for r in got) == brute(rows, 400)


def test_kept_texts_keep_characters_and_columns(documents):
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choice("aéßz ") for _ in range(n))
    shared = noise(500)
    docs = documents([(i, noise(50) + shared + noise(60)) for i in range(4)] + [(9, None)])
    got = repeats.remove_repeats(docs)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in got.collect()}
    assert rows[9] == "" and all(105 <= len(rows[i]) <= 115 for i in range(4))


@pytest.mark.parametrize("size", [0, 399, 400, 401])
def test_spans_of_a_copy(size):
    import numpy as np

    none = np.zeros((0, 2), np.int64)
    assert repeats.spans(size, none, True, 400).tolist() == ([[0, size]] if size >= 400 else [])


def test_empty_table(documents):
    assert repeats.repeat_digest(documents([])).count() == 0


def test_copies_are_gathered_once(documents, monkeypatch):
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = noise(900)
    copied = noise(300) + passage + noise(300)
    rows = [(i, copied) for i in range(40)] + [(100, noise(500) + passage), (101, passage[:600] + noise(500)), (102, noise(700))]
    plain = repeats._suffixes

    def once(length):
        run = plain(length)

        def checked(batches):
            for batch in batches:
                for places in batch.column("places").to_pylist():
                    found = [(p["pos"], p["side"]) for p in places]
                    assert len(found) == len(set(found)), "an anchor is gathered once per copy"
                yield from run([batch])

        return checked

    monkeypatch.setattr(repeats, "_suffixes", once)
    got = repeats.repeat_digest(documents(rows)).collect()
    assert sorted((r[0], *tuple(r)[1:]) for r in got) == brute(rows, 400)


def brute_kept(rows, length, words):
    """Texts without all that a repeated string of bytes or passage of words covers."""
    texts = {i: t.encode() for i, t in rows}
    seen, passages = Counter(), Counter()
    found = {i: list(re.finditer(rb"[^\x20\x09-\x0D]+", b)) for i, b in texts.items()}
    runs = {i: [tuple(m.group() for m in f[k : k + words]) for k in range(len(f) - words + 1)] for i, f in found.items()}
    for i, b in texts.items():
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
        passages.update(runs[i])
    out = {}
    for i, b in texts.items():
        gone = [(k, k + length) for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1]
        gone += [(found[i][k].start(), found[i][k + words - 1].end()) for k, r in enumerate(runs[i]) if passages[r] > 1]
        kept = bytearray(b)
        for start, end in gone:
            kept[start:end] = b"\xff" * (end - start)
        out[i] = bytes(x for x in kept if x != 0xFF).decode()
    return out


def test_passages_of_words_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr(repeats, "LEAST_HOT", 3)
    monkeypatch.setattr(repeats, "SHARES", 50)
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("aä be cde no if") + rng.choice("stuvwxyz") for _ in range(n))
    short, longer, line = say(51), say(70), say(12)
    assert len(short.encode()) < 400
    rows = [(i, f"{say(rng.randint(0, 90))}\n{short if i % 2 else longer}\n{say(rng.randint(0, 60))}") for i in range(12)]
    rows += [(20, short.replace(" ", " \t\n")), (21, say(30) + " " + " ".join(short.split()[:50])), (22, short), (23, short)]
    rows += [(30 + i, say(60) + "\n" + line + "\n" + say(60)) for i in range(8)] + [(40, "x" * 450 + say(3)), (41, "x" * 450), (42, "")]
    rows += [(43, short + " " + say(5) + " " + short), (44, "o " * 80)]
    got = repeats.remove_repeats(documents(rows), words=51).collect()
    want = brute_kept(rows, 400, 51)
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert any(short in t for _, t in rows) and not any(short in t for t in want.values())
