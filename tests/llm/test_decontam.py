import random

import numpy as np
import pytest

from dwellspark.llm import decontam
from tests.llm.conftest import sentence


def words(n, rng):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def brute(docs, items):
    out = {}
    for i, text in docs:
        for j, item in items:
            own = decontam._item_words([text or ""])[0]
            want = decontam._item_words([item or ""])[0]
            if len(want):
                edits = decontam.distance(want, own)[0]
                if edits <= decontam.edits(len(want)):
                    out[i, j] = edits
    return out


def test_distance_by_hand():
    a = np.array([1, 2, 3, 4, 5], np.uint64)
    assert decontam.distance(a, np.array([9, 9, 1, 2, 7, 4, 5, 9], np.uint64)) == (1, 7)
    assert decontam.distance(a, np.array([1, 2, 3, 8, 4, 5], np.uint64))[0] == 1
    assert decontam.distance(a, np.array([], np.uint64))[0] == 5


def test_recall_at_the_limit_and_no_false_find(spark):
    rng = random.Random(5)
    items = [(j, " ".join(words(rng.randint(8, 60), rng))) for j in range(40)]
    docs = []
    for i in range(200):
        item = items[i % 40][1].split()
        for _ in range(decontam.edits(len(item)) if i % 4 else 0):
            at, kind = rng.randrange(len(item)), rng.random()
            if kind < 0.4:
                item[at] = "new"
            elif kind < 0.7:
                item.insert(at, "more")
            else:
                del item[at]
        docs.append((i, " ".join(words(150, rng) + item + words(150, rng))))
    docs += [(i, sentence(rng, "en", 300)) for i in range(300, 320)]
    want = brute(docs, items)
    got = decontam.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in got}
    assert set(found) <= set(want)
    assert len(found) >= 0.9 * len(want)
    assert all(found[p] == want[p] for p in found)
    exact = {p for p, e in want.items() if e == 0}
    assert exact and exact <= set(found)


@pytest.mark.parametrize("kinds", ["mixed", "replaced"])
@pytest.mark.parametrize("n", [8, 16, 17, 30, 50, 100, 200, 400])
def test_recall_at_the_limit_by_length(n, kinds):
    rng = random.Random(n)
    items, docs = [], []
    for _ in range(60):
        item = words(n, rng)
        items.append(" ".join(item))
        left = list(item)
        for at in rng.sample(range(n), decontam.edits(n)) if kinds == "replaced" else ():
            left[at] = "new"
        for _ in range(decontam.edits(n) if kinds == "mixed" else 0):
            at, kind = rng.randrange(len(left)), rng.random()
            left[at : at + (kind > 0.35)] = ["new"] if kind < 0.7 else []
        docs.append(" ".join(words(80, rng) + left + words(80, rng)))
    index = decontam.Index(list(range(len(items))), decontam._item_words(items))
    found = 0
    for i, doc in enumerate(decontam._item_words(docs)):
        found += (0, i) in index.search(doc, np.array([0, len(doc)]))
    assert found >= 0.95 * len(items), found / len(items)


def test_edges(documents, spark):
    items = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, "!!!"), (4, "one two three four five six seven")], "item_id long, text string")
    docs = documents(
        [(1, "x ALPHA, beta y"), (2, None), (3, ""), (4, "alpha gamma beta"), (5, "one two 3 four five six seven"), (5, "one two 3 four five six seven"), (6, "alpha"), (7, "beta")]
    )
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontam.leaks(docs, items).collect()}
    assert got == {(1, 1, 0), (5, 4, 1)}
    assert decontam.leaks(documents([]), items).count() == 0
    assert decontam.leaks(docs, items.limit(0)).count() == 0


def test_blocks_of_the_benchmark_give_the_same(documents, spark, monkeypatch, rng):
    items = [(j, sentence(rng, "de", 20)) for j in range(10)]
    docs = documents([(j, sentence(rng, "fr", 50) + " " + t) for j, t in items])
    frame = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.leaks(docs, frame).collect()))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 600)
    assert sorted(map(tuple, decontam.leaks(docs, frame).collect())) == whole and len(whole) >= 10
