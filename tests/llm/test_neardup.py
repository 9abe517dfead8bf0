import random
import re
import tracemalloc

import pyarrow as pa

from dwellspark.llm import neardup


def shingle_set(text, n):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


def brute(rows, n, percent=80):
    sets = [shingle_set(t, n) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    least = {}
    for (doc, _), c in zip(rows, label, strict=True):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted((doc if doc is not None else -1, len(s), least.get(c, -1)) for (doc, _), s, c in zip(rows, sets, label, strict=True))


def run(df, n):
    got = neardup.near_duplicates(df, shingle=n)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in rows)
    fill = lambda x: -1 if x is None else x
    return sorted((fill(r["doc_id"]), r["n_shingles"], fill(r["component_id"])) for r in rows)


def edited(words, count, rng):
    out = list(words)
    for _ in range(count):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_floor_of_shared_values():
    assert neardup.overlap_floor(32, 80) <= 12 and neardup.overlap_floor(128, 80) > neardup.overlap_floor(32, 80)


def test_groups_copies_and_edges_against_brute_force(documents):
    rng = random.Random(2)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(8, 200))]
        rows += [(len(rows), edited(base, rng.randint(0, max(1, len(base) // 9)), rng)) for _ in range(rng.randint(1, 5))]
    # A large group of near copies of which not all pairs are similar, and a passage in many texts.
    base = [f"b{i}" for i in range(120)]
    rows += [(1000 + i, edited(base, rng.randint(2, 14), rng)) for i in range(90)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(2000 + i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60)))) for i in range(60)]
    rows += [(3000, "One"), (3001, "one"), (3002, "a b c d e"), (3003, "a b c d f"), (3004, "a b c d e f"), (3005, None), (3006, ""), (3007, " \t ")]
    rows += [(3008, "same TEXT here now"), (3009, "same text\there now")] * 2 + [(None, "same text here now"), (None, "")]
    assert run(documents(rows), 2) == brute(rows, 2)


def test_empty_table(documents):
    assert neardup.near_duplicates(documents([])).count() == 0


def test_nodes_of_a_level_are_read_from_storage(documents, monkeypatch):
    """Each level reads its nodes twice, so none may be a join that would be done twice."""
    plans, postings = [], neardup._postings

    def seen(nodes, *rest):
        plans.append(nodes._jdf.queryExecution().optimizedPlan().toString())
        return postings(nodes, *rest)

    monkeypatch.setattr(neardup, "_postings", seen)
    neardup.near_duplicates(documents([(i, f"a b c d e f{i % 3}") for i in range(9)]), shingle=2)
    assert len(plans) == len(neardup.SKETCHES) and not any("Join" in p for p in plans)


def test_nodes_are_listed_once_before_the_last_level(documents, monkeypatch):
    """A common passage makes every list long; with a level for few values all nodes were listed twice."""
    listed, postings = [], neardup._postings

    def seen(nodes, *rest):
        listed.append(nodes.count())
        return postings(nodes, *rest)

    monkeypatch.setattr(neardup, "_postings", seen)
    rng, passage = random.Random(5), " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{passage} " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(30))) for i in range(50)]
    assert run(documents(rows), 2) == brute(rows, 2)
    assert sum(listed[:-1]) == len(rows)


def test_memory_of_sketches_follows_the_sketches(rng):
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(2000)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    tracemalloc.start()
    for _ in neardup._sketch(2, 32)(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6
