import hashlib
import random
import zlib

import pytest

from dwellspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g string, pos int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Levels of a plain tree, and for each leaf what stands beside its path."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 8
        out.append((level[run:i], level[i + 1 : run + 8]))
        i //= 8
    return out


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    parts = {}
    for doc_id, text, lang, source, n in rows:
        own = sha("".join(map(field, (doc_id, source, lang, n, text))))
        hit = zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 0
        other = sha("".join(map(field, (doc_id, source, lang, n, lower(text))))) if hit else own
        key = (lang is not None, (lang or "").encode())
        parts.setdefault(key, []).append(((doc_id is not None, doc_id or 0, own), other))
    names = sorted(parts)
    trees = {k: tree([leaf for (_, _, leaf), _ in sorted(parts[k])]) for k in names}
    above = tree([trees[k][-1][0] for k in names])
    out = []
    for number, k in enumerate(names):
        for i, ((known, doc_id, own), other) in enumerate(sorted(parts[k])):
            path = beside(trees[k], i) + beside(above, number)
            folded = other
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            root = above[-1][0]
            out.append((doc_id if known else None, own, trees[k][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def rows():
    rng = random.Random(2)
    words = ["Ab", "c", "É", "Straße", "", "x\ny", "9:"]
    out = [(i, " ".join(rng.choices(words, k=5)), "en", "s", i % 7) for i in range(700)]
    out += [(1000 + i, rng.choice([None, "", "PLAIN", "plain"]), "é", None, None) for i in range(65)]
    out += [(5, "One", "de", "s", 1), (6, "Two", None, "s", 1), (None, "Three", None, "s", 1), (None, None, None, None, None)]
    out += [(8, "S", "zz", "s", 1)] * 9 + [(8, "T", "zz", "s", 1), (-3, "U" * 50_000, "zz", "s", 1)]
    return out + [(3000 + i, "N", f"lang{i}", "s", 1) for i in range(20)]


def test_against_a_plain_tree(spark, rows):
    assert found(merkle.manifest(frame(spark, rows))) == brute(rows)


def test_several_rounds_of_blocks(spark, rows):
    got = merkle.manifest(frame(spark, rows), with_versions=True, levels=1)
    assert found(got.drop("version")) == brute(rows)
    for r in got.select("doc_id", "leaf", "folded_root", "version").collect():
        if r["version"] is not None:
            assert r["version"][-1] == r["folded_root"]


@pytest.mark.parametrize("n", [1, 8, 65])
def test_sizes_around_a_full_level(spark, n):
    rows = [(i, "Text", "en", "s", 1) for i in range(n)]
    assert found(merkle.manifest(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_a_version_shares_all_but_its_path():
    base = merkle.Tree.build([sha(str(i)) for i in range(100)], 3)
    other = base.version(77, sha("new"))
    plain = merkle.Tree.build([sha("new") if i == 77 else sha(str(i)) for i in range(100)], 3)
    assert [[other.node(level, i) for i in range(len(nodes))] for level, nodes in enumerate(plain.levels)] == [list(x) for x in plain.levels]
    assert len(other.copied) == 4 and other.top == plain.top != base.top
    assert base.version(77, base.levels[0][77]).top == base.top
