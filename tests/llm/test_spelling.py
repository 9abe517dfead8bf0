import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dwellspark.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, cell string, root double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "c", 0.5) for i, t in rows], SCHEMA).repartition(3)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def brute(rows):
    words = counts(rows)
    forms, near = {}, {}
    for w, n in words.items():
        beside = [v for v in words if one_edit(w, v)]
        near[w] = len(beside)
        best = min(beside, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near[w], words[forms[w]] if forms[w] else None))
    return sorted(out)


def corpus(rng):
    stems = ["window", "windows", "Windows", "fenêtre", "straße", "ÀÉÎÕÜÿ", "letter", "lettre", "aaaaaaa", "aaaaaaaa", "x" * 3000]
    letters = "abcdeÉÿ×"
    words = list(stems)
    for stem in stems[:9] * 12:
        at = rng.randrange(len(stem))
        c = rng.choice(letters)
        words.append(rng.choice([stem[:at] + c + stem[at:], stem[:at] + c + stem[at + 1 :], stem[:at] + stem[at + 1 :]]))
    # Anagrams have one vector and no edit between them.
    words += ["".join(rng.sample("abcdefg", 7)) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights=[60 if w in stems else 2 for w in words], k=120)) + ".") for i in range(160)]
    return rows + [(None, "window " * 400), (1, None), (2, ""), (3, "12 -- ´"), (7, "window"), (7, "window")] + rows[:5]


@pytest.mark.parametrize("sizes", [{}, {"most": 8, "sample": 90}])
def test_against_brute_force(spark, sizes):
    rows = corpus(random.Random(4))
    got = sorted(map(tuple, spelling.spelling_groups(frame(spark, rows), **sizes).collect()))
    assert got == brute(rows)


def test_empty_table(spark):
    assert spelling.spelling_groups(frame(spark, [])).count() == 0


def test_roots_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w3")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(f"w{i}", "w11") for i in range(11)} | {("v", "w11")}


def test_a_tree_reaches_all_within_the_radius():
    rng = np.random.default_rng(8)
    codes = rng.choice(np.frombuffer(b"abcde", np.uint8), (400, 7))
    points = spelling.vectors(codes)
    tree = spelling.Tree.build(points, 10)
    home = np.full(len(points), -1)
    for leaf, some in tree.reached(points, 0):
        assert (home[some] == -1).all()
        home[some] = leaf
    assert (home >= 0).all() and tree.leaves > 10
    for radius in (1, 2):
        reached = {(leaf, int(i)) for leaf, some in tree.reached(points, radius) for i in some}
        close = np.abs(points[:, None] - points[None]).sum(axis=2) <= radius
        assert all((int(home[j]), int(i)) in reached for i, j in zip(*np.nonzero(close), strict=True))
        assert len(reached) < tree.leaves * len(points)


def test_anagrams_alone_are_one_leaf():
    points = spelling.vectors(spelling.letters_of(["abcdefg", "gfedcba", "bacdefg"] * 40))
    assert spelling.Tree.build(points, 5).held == [120]


def test_more_anagrams_than_a_cell_holds(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("abcdefg", 7)) for _ in range(300)} | {"abcdefgh", "xbcdefg"})
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    cells = spelling.upper_trees(frame, 20, 1000)
    assert len(cells[7].start) < len(words) / 20 < cells[7].start[-1]
    got = sorted(map(tuple, spelling.near_words(frame, 20, 1000).collect()))
    assert got == sorted((a, b, words.index(b)) for a in words for b in words if one_edit(a, b))
