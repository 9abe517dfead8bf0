"""Grouping of spelling variants by k-d trees over letter counts.

1. Words are counted per task and summed by Spark. A word in so many (by a hash) of a document loses a
   letter first; what results is counted like any other.
2. One edit moves a word's vector of letter counts by 1 (a letter more or less) or 2 (another letter)
   in L1 distance. So near words lie in a ball around a word, of radius 2 among words of its length and
   1 among words that are a letter longer.
3. For every length with many words an upper k-d tree, split at medians of a bounded sample, divides the
   words into cells of about CELL_WORDS; every word lies in one cell. A word visits the cells of its
   length and the next whose boxes its balls reach: Spark brings words and visitors together by cell.
   Words that have one vector (anagrams) cannot be split by it: they are dealt by hash over several
   cells, and a visitor goes to all of them.
4. Inside a cell a k-d tree of its own prunes boxes again, down to leaves of few words. There parities
   of the counts (a bound of the L1 distance), then counts, then the order of the letters decide.
5. Forms are the largest near words, and roots follow forms by pointer doubling.

Nothing but word counts per length and the sampled vectors comes to the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.tables import stored

#: Fewest letters and occurrences of a word, and how much more frequent a form has to be.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: One in so many words of a document loses a letter.
LOSES_LETTER = 199
#: Words of a cell, bytes of their letters, and words of a leaf inside it.
CELL_WORDS, CELL_BYTES, LEAF_WORDS = 4096, 4 << 20, 48
#: Sampled vectors (360 bytes each) from which the upper trees are split: what the driver gets at most.
SAMPLE = 65_536
#: Words that a task counts before it passes them on, and pairs of a leaf that are compared at once.
HELD, PAIRS = 200_000, 1 << 20
#: Characters above which the words of a text are not listed but iterated.
LONG_TEXT = 1 << 20

#: Places of letters in a vector: a to z, then U+00C0 to U+00FF.
PLACE = np.full(256, -1, np.int64)
PLACE[97:123] = np.arange(26)
PLACE[0xC0:] = 26 + np.arange(64)
WIDTH = 90
#: Bits of a parity: the rare letters share some, which keeps it a bound.
BIT = np.uint64(1) << (np.arange(WIDTH) % 64).astype(np.uint64)


def counted(letters: int = LETTERS, loses: int = LOSES_LETTER):
    """Batches of ``id, text`` to ``word, n``: words of ``letters`` and more with their occurrences."""
    word_of = re.compile(f"[a-zÀ-ÿ]{{{letters},}}")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def flush(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, raw in zip(batch.column("id"), batch.column("text"), strict=True):
                text = (raw.as_py() or b"").lower().decode("utf-8")
                found = (m.group() for m in word_of.finditer(text)) if len(text) > LONG_TEXT else word_of.findall(text)
                number = doc_id.as_py()
                start = zlib.crc32(f"{'' if number is None else number}:".encode())
                for word, n in Counter(found).items():
                    h = zlib.crc32(word.encode("utf-8"), start)
                    if h % loses == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield flush(total)
                    total.clear()
        yield flush(total)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words with LETTERS letters and OCCURRENCES occurrences in ``docs``."""
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    words = base.mapInArrow(counted(), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURRENCES)


def letters_of(words: list[str]) -> np.ndarray:
    """Codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    rows = np.arange(len(codes))[:, None] * WIDTH + PLACE[codes]
    return np.bincount(rows.ravel(), minlength=len(codes) * WIDTH).reshape(-1, WIDTH).astype(np.int32)


def parities(counts: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(np.where(counts & 1, BIT, np.uint64(0)), axis=1)


@dataclass
class Tree:
    """A k-d tree whose leaves, numbered from 0, divide all of the space between them."""

    axis: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    #: Points of each leaf when the tree was built.
    held: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return len(self.held)

    @classmethod
    def build(cls, points: np.ndarray, leaf_points: float) -> Tree:
        """Splits where both sides are most even, until a leaf has ``leaf_points`` or all are equal."""
        tree = cls()
        tree._grow(points, leaf_points)
        return tree

    def _grow(self, points: np.ndarray, leaf_points: float) -> int:
        at = len(self.axis)
        for column in (self.axis, self.cut, self.left, self.right, self.leaf):
            column.append(-1)
        best = (0, 0, 0)
        if len(points) > leaf_points:
            ordered = np.sort(points, axis=0)
            middle = ordered[(len(points) - 1) // 2]
            for cut in (middle, middle - 1):
                below = (points <= cut).sum(axis=0)
                even = np.minimum(below, len(points) - below)
                axis = int(np.argmax(even))
                best = max(best, (int(even[axis]), -axis, int(cut[axis])))
        if best[0] == 0:
            self.leaf[at] = self.leaves
            self.held.append(len(points))
            return at
        self.axis[at], self.cut[at] = -best[1], best[2]
        low = points[:, self.axis[at]] <= self.cut[at]
        self.left[at] = self._grow(points[low], leaf_points)
        self.right[at] = self._grow(points[~low], leaf_points)
        return at

    def reached(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves whose boxes lie within L1 distance ``radius`` of points, with those points."""
        far = np.iinfo(np.int32).max
        box = np.array([[-far] * WIDTH, [far] * WIDTH], np.int64)
        stack = [(0, np.arange(len(points)), np.zeros(len(points), np.int64), box)]
        while stack:
            at, some, distance, box = stack.pop()
            if not len(some):
                continue
            if self.leaf[at] >= 0:
                yield self.leaf[at], some
                continue
            axis, cut = self.axis[at], self.cut[at]
            value = points[some, axis]
            # The gap along this axis is replaced by that to the smaller box.
            rest = distance - np.maximum(np.maximum(box[0, axis] - value, value - box[1, axis]), 0)
            for child, side, bound in ((self.left[at], 1, cut), (self.right[at], 0, cut + 1)):
                inner = box.copy()
                inner[side, axis] = bound
                now = rest + np.maximum(np.maximum(inner[0, axis] - value, value - inner[1, axis]), 0)
                keep = now <= radius
                stack.append((child, some[keep], now[keep], inner))


def cell_words(length: int, most: int = CELL_WORDS) -> int:
    return max(1, min(most, CELL_BYTES // length))


@dataclass
class Cells:
    """Cells of the words of one length: leaf i of the tree has those from start[i] up to start[i + 1]."""

    tree: Tree
    start: list[int]


def upper_trees(words: DataFrame, most: int = CELL_WORDS, sample: int = SAMPLE) -> dict[int, Cells]:
    """For every length its cells."""
    counts = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    large = [length for length, n in counts.items() if n > cell_words(length, most)]
    points: dict[int, list[bytes]] = defaultdict(list)
    if large:
        some = words.filter(F.length("word").isin(large)).select("word").orderBy(F.xxhash64("word"), "word").limit(sample)
        for r in some.mapInArrow(_as_vectors, "length int, counts binary").collect():
            points[r["length"]].append(bytes(r["counts"]))
    trees, first = {}, 0
    for length, n in sorted(counts.items()):
        own = np.frombuffer(b"".join(points[length]), np.int32).reshape(-1, WIDTH)
        share = cell_words(length, most) * len(own) / n
        tree = Tree.build(own, share)
        start = [first]
        for held in tree.held:
            start.append(start[-1] + max(1, math.ceil(held / max(share, 1))))
        trees[length] = Cells(tree, start)
        first = start[-1]
    return trees


def _as_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        counts = [vectors(letters_of([w])).tobytes() for w in words]
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(map(len, words), pa.int32()), "counts": pa.array(counts, pa.binary())}
        )


#: How a word comes to a cell: it lies there, it visits words of its length, or longer ones.
LIES, VISITS, LONGER = 0, 1, 2


def _dealt(trees: dict[int, Cells]):
    schema = pa.schema([("cell", pa.int64()), ("role", pa.int8()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n")
            lengths = np.array([len(w) for w in words])
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                for part in np.array_split(own, -(-len(own) * length // CELL_BYTES)):
                    counts = vectors(letters_of([words[i] for i in part]))
                    mixed = np.array([zlib.crc32(words[i].encode("utf-8")) for i in part])
                    visits = [(length, 0, LIES), (length, 2, VISITS), (length + 1, 1, LONGER)]
                    home = np.full(len(part), -1)
                    for target, radius, role in visits:
                        if target not in trees:
                            continue
                        cells = trees[target]
                        for leaf, some in cells.tree.reached(counts, radius):
                            low, high = cells.start[leaf : leaf + 2]
                            for cell in range(low, high):
                                here = some
                                if role == LIES:
                                    here = some[mixed[some] % (high - low) == cell - low]
                                    home[here] = cell
                                elif role == VISITS:
                                    # Where it lies, a word is a visitor too.
                                    here = some[home[some] != cell]
                                rows = pa.array(part[here])
                                yield pa.RecordBatch.from_arrays(
                                    [
                                        pa.array(np.full(len(here), cell)),
                                        pa.array(np.full(len(here), role, np.int8)),
                                        batch.column("word").take(rows),
                                        n.take(rows),
                                    ],
                                    schema=schema,
                                )

    return run


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of letters that differ in one place."""
    return (a != b).sum(axis=1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``b`` that are those of ``a`` with one more letter."""
    length = a.shape[1]
    front = np.cumprod(a == b[:, :length], axis=1, dtype=bool).sum(axis=1)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=bool).sum(axis=1)
    return front + back >= length


def _pairs(tree: Tree, members: list[np.ndarray], points: tuple, visitors: tuple, radius: int) -> Iterator[tuple]:
    """Places of visitors and points whose vectors lie within the radius."""
    (counts, parity), (other, other_parity) = points, visitors
    for leaf, some in tree.reached(other, radius):
        own = members[leaf]
        step = max(PAIRS // len(own), 1) if len(own) else len(some)
        for start in range(0, len(some) if len(own) else 0, step):
            now = some[start : start + step]
            apart = np.bitwise_count(other_parity[now][:, None] ^ parity[own][None, :])
            i, j = np.nonzero(apart <= radius)
            i, j = now[i], own[j]
            for at in range(0, len(i), PAIRS // WIDTH):
                x, y = i[at : at + PAIRS // WIDTH], j[at : at + PAIRS // WIDTH]
                good = np.abs(other[x] - counts[y]).sum(axis=1) <= radius
                yield x[good], y[good]


NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def near_in_cell(table: pa.Table) -> pa.Table:
    """Near words of a cell: rows ``word, near, near_n``, each pair in the directions that end here."""
    role = table["role"].to_numpy()
    words, n = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
    at = {LIES: np.flatnonzero(role == LIES), VISITS: np.flatnonzero(role <= VISITS), LONGER: np.flatnonzero(role == LONGER)}
    left, right = [], []
    if len(at[LIES]):
        codes = letters_of(words[at[LIES]].tolist())
        counts = vectors(codes)
        tree = Tree.build(counts, LEAF_WORDS)
        members = [np.zeros(0, np.int64)] * tree.leaves
        for leaf, some in tree.reached(counts, 0):
            members[leaf] = some
        points = counts, parities(counts)
        for kind, radius, verified in ((VISITS, 2, replaced), (LONGER, 1, inserted)):
            if not len(at[kind]):
                continue
            own = letters_of(words[at[kind]].tolist())
            own_counts = vectors(own)
            for i, j in _pairs(tree, members, points, (own_counts, parities(own_counts)), radius):
                good = verified(own[i], codes[j])
                i, j = at[kind][i[good]], at[LIES][j[good]]
                left.append(i)
                right.append(j)
                if kind == LONGER:
                    left.append(j)
                    right.append(i)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    return pa.Table.from_arrays(
        [pa.array(words[a], pa.string()), pa.array(words[b], pa.string()), pa.array(n[b], pa.int64())], schema=NEAR
    )


def near_words(words: DataFrame, most: int = CELL_WORDS, sample: int = SAMPLE) -> DataFrame:
    """``word, near, near_n``: all pairs of ``words`` (word, n) that are one edit apart, both ways."""
    trees = upper_trees(words, most, sample)
    dealt = words.mapInArrow(_dealt(trees), "cell long, role byte, word string, n long")
    return dealt.groupBy("cell").applyInArrow(near_in_cell, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of ``word, form`` rows, which has no cycles.

    Every round doubles how far a root lies ahead; forms grow at least TIMES-fold, so a handful of
    rounds is enough.
    """
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left")
        now = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z in lower case, of LETTERS letters and
    OCCURRENCES occurrences and more. A null text has no words, a null id counts as an empty text in
    the choice of letters that get lost, and repeated rows count again. ``form`` is the near word with
    most occurrences (of equals the first by code points) if it has TIMES those of the word, else null;
    ``root`` follows forms to the last. An empty table has no words. Other columns are not read.
    """
    words = stored(vocabulary(docs, id_col, text_col))
    best = F.min(F.struct((-F.col("near_n")).alias("most"), "near"))
    near = near_words(words, **sizes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = (-F.col("best.most")) >= TIMES * F.col("n")
    known = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form, F.col("best.near")).alias("form"),
            F.when(form, -F.col("best.most")).alias("form_n"),
        )
    )
    ends = roots(known.filter(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
