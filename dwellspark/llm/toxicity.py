"""Toxicity of texts whose words may be disguised.

*Restoring.* A disguised word is a lattice: each of its characters may stand for itself, for a letter
that looks alike, for nothing, or a run of it for one or two of it. Letters that stand apart form one
word. Viterbi's search finds the path that is most likely under a model of character triples, which
is counted over all documents, and under the costs of each disguise.

*Scoring.* A logistic regression on words and on beginnings of words, as far as they tell toxic
texts apart, over the restored text. It is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm import hashing
from dwellspark.llm.tables import stored, whole_text

#: Letters that a digit or sign may stand for.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t",
}
#: Signs that separate the letters of one word.
BETWEEN = ".-_*'~"
#: Logarithms of the chances of a disguise.
AS_LETTER, AS_NOTHING, SHORTER, APART = math.log(0.2), math.log(0.005), math.log(0.3), math.log(0.5)
#: A look-alike between other characters is hardly ever mere decoration.
INNER = math.log(1e-6)
#: What a letter adds, about its usual cost, so that short texts have no advantage.
PER_LETTER = 2.3
#: Letters of the model: blank, a to z, any other.
LETTERS, OTHER = 28, 27
#: Labelled rows of the training sample, and words that the model may use.
SAMPLE_ROWS, MOST_FEATURES = 12_000, 4_096
#: Least evidence (G statistic) and least documents of a word that is used.
EVIDENCE, LEAST_ROWS = 15.0, 4
#: Disguised words that a worker remembers.
REMEMBERED = 300_000

CODE = np.zeros(256, np.int64)
CODE[97:123] = np.arange(1, 27)
CODE[65:91] = np.arange(1, 27)
CODE[128:] = OTHER
_LETTER = CODE > 0
_LOOKALIKE = np.zeros(256, bool)
_LOOKALIKE[[ord(c) for c in LOOKALIKE]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[ord(c) for c in BETWEEN]] = True
_BLANK = hashing.byte_set(0x20, range(0x09, 0x0E))
_WORD = re.compile(r"[^\W\d_]+")


def letter_code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else OTHER


# Counting character triples


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("triple", pa.int32()), ("n", pa.int64())])
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        for group in hashing.groups(batch.column("text")):
            codes = CODE[group.data]
            # A text ends in a blank; runs of blanks count as one.
            ends = group.bounds[1:-1]
            codes = np.insert(codes, np.concatenate([[0], ends, [len(codes)]]), 0)
            codes = codes[np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])]
            if len(codes) > 2:
                total += np.bincount((codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], minlength=LETTERS**3)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=schema)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log chance of a letter after two others, from all texts; its table has a fixed size."""
    counts = docs.select(whole_text(F.col("text")).alias("text")).mapInArrow(_count, "triple int, n long")
    rows = counts.groupBy("triple").agg(F.sum("n").alias("n")).collect()
    table = np.full(LETTERS**3, 0.1)
    for row in rows:
        table[row["triple"]] += row["n"]
    table = table.reshape(LETTERS, LETTERS, LETTERS)
    return np.log(table / table.sum(axis=2, keepdims=True)).astype(np.float32)


# Restoring


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character the texts it may stand for, with the cost of each."""
    nodes = []
    last = len(token)
    for run in re.finditer(r"(.)\1*", token, re.S):
        inner = 0 < run.start() and run.end() < last
        char, size = run.group(1), len(run.group())
        if char.isalpha():
            options = [(char, 0.0 if size == 1 else SHORTER)]
            if size > 1:
                options.append((char * 2, 0.0 if size == 2 else SHORTER))
        elif char in LOOKALIKE:
            options = [(c, AS_LETTER) for c in LOOKALIKE[char]] + [("", INNER if inner else AS_NOTHING)]
            if size > 1:
                options += [(c * 2, AS_LETTER) for c in LOOKALIKE[char]]
        else:
            options = [("", AS_NOTHING if char not in BETWEEN else APART)]
        nodes.append(options)
    return nodes


def viterbi(nodes: list[list[tuple[str, float]]], model: np.ndarray) -> tuple[str, float]:
    """Likeliest text of a lattice and its score, a blank before and after it."""
    states = {(0, 0): (0.0, "")}
    for options in [*nodes, [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (x, y), (score, text) in states.items():
            for piece, cost in options:
                a, b, now = x, y, score + cost
                for char in piece:
                    c = 0 if char == " " else letter_code(char)
                    now += float(model[a, b, c]) + PER_LETTER
                    a, b = b, c
                if (a, b) not in after or now > after[a, b][0]:
                    after[a, b] = (now, text + piece)
        states = after
    score, text = max(states.values())
    return text.strip(), score


_DISGUISED = re.compile(r"[^\W\d_][0-9@$!|+]+[^\W\d_]|[0-9@$!|+][^\W\d_]{2}|[^\W\d_]{2}[0-9@$|+]$|([^\W\d_])\1\1|[^\W\d_][.\-_*'~]+[^\W\d_][.\-_*'~]")

#: Words whose likeliest reading must beat the plain one: letters in pairs, or mostly look-alikes.
_DOUBLED = re.compile(r"([a-z])\1")
_MOSTLY = re.compile(r"(?=.{4})[0-9@$!|+]+[a-z]+[0-9@$!|+]+[a-z]?$")
#: By how much (a logarithm) the reading without pairs must be likelier.
MARGIN = 2.0


@dataclass
class Restorer:
    """Restores texts under a character model and remembers words."""

    model: np.ndarray
    words: dict[str, str] = field(default_factory=dict)

    def word(self, token: str) -> str:
        """The token without its disguise; itself where it has none or has no likely reading."""
        found = self.words.get(token)
        if found is None:
            # Decoration at the ends is no part of the word.
            core = re.sub(r"^[^\w@$!|+]+|[^\w@$|+]+$|([@$!|+*%#&])\1+$", "", token)
            found = token
            if _DISGUISED.search(core) and sum(c.isalpha() for c in core) >= 2:
                found = viterbi(lattice(core), self.model)[0] or token
            elif _MOSTLY.match(core):
                # Taken if its letters are likely ones, whatever the disguise costs.
                read, score = viterbi(lattice(core), self.model)
                if len(read) > 2 and score > AS_LETTER * sum(c in LOOKALIKE for c in core):
                    found = read
            elif core.isalpha() and _DOUBLED.search(core):
                read, score = viterbi(lattice(core), self.model)
                if score > viterbi([[(core, 0.0)]], self.model)[1] + MARGIN:
                    found = token.replace(core, read)
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[token] = found
        return found

    def text(self, text: str) -> str:
        """The text in lower case, disguised words and letters that stand apart restored."""
        out, apart = [], []
        for token in [*text.lower().split(), ""]:
            single = token.strip(BETWEEN + ",")
            if len(single) == 1 and (single.isalpha() or single in LOOKALIKE):
                apart.append(single)
                continue
            end = len(apart)
            while end and not apart[end - 1].isalnum():
                end -= 1
            if end > 2 and sum(c.isalpha() for c in apart) >= 2:
                out += [self.word("_".join(apart[:end])), *apart[end:]]
            else:
                out += apart
            apart = []
            out.append(self.word(token))
        return " ".join(out).strip()


def disguised(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a text has a place that may be a disguise."""
    size = len(data)
    letter = np.zeros(size + 4, bool)
    letter[2:-2] = _LETTER[data]
    look = np.zeros(size + 4, bool)
    look[2:-2] = _LOOKALIKE[data]
    blank = np.ones(size + 4, bool)
    blank[2:-2] = _BLANK[data]
    between = np.zeros(size + 4, bool)
    between[2:-2] = _BETWEEN[data]
    before, after, later = slice(1, -3), slice(3, -1), slice(4, None)
    here = slice(2, -2)
    signs = look[here] & letter[after] | look[here] & letter[before] & ~letter[after] & (data != 33)
    lower = data | 32
    twice = np.zeros(size, bool)
    twice[1:] = (lower[1:] == lower[:-1]) & letter[here][1:] & letter[here][:-1] & (data[1:] < 128)
    cut = letter[before] & between[here] & letter[after] & between[later]
    # A blank, one letter or sign, a blank, and another one.
    alone = blank[before] & (letter[here] | look[here]) & (blank | between)[after] & (letter | look)[later]
    total = np.concatenate([[0], np.cumsum(signs | twice | cut | alone)])
    return total[bounds[1:]] > total[bounds[:-1]]


# Scoring


@dataclass
class Scorer:
    model: np.ndarray
    weights: dict[str, float]
    offset: float


def features(text: str) -> set[str]:
    """Words, and beginnings of four and five letters, marked with a star."""
    words = set(_WORD.findall(text))
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def _texts(column: pa.Array, restorer: Restorer) -> Iterator[str]:
    texts = column.to_pylist()
    for group in hashing.groups(column):
        marks = disguised(group.data, group.bounds)
        for i, mark in enumerate(marks):
            text = texts[group.first + i]
            yield restorer.text(text) if mark else text.lower()


def _mark(feature: str) -> int:
    return zlib.crc32(feature.encode())


def _sample_features(model: np.ndarray, wanted: frozenset[int] | None):
    """Numbers of the features of each sampled row, or the spelling of wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            sets = [features(t) for t in _texts(batch.column("text"), restorer)]
            if wanted is None:
                marks = [np.unique(np.fromiter(map(_mark, s), np.int64, len(s))) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(marks, pa.list_(pa.int64()))], names=["toxic", "marks"])
            else:
                spelled = sorted({f for s in sets for f in s if _mark(f) in wanted})
                yield pa.RecordBatch.from_arrays([pa.array([_mark(f) for f in spelled], pa.int64()), pa.array(spelled, pa.string())], names=["mark", "feature"])

    return run


def evidence(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """G statistic of a feature, positive where it is more frequent in toxic texts."""
    total = toxic + clean
    out = np.zeros(len(with_toxic))
    for seen, all_ in ((with_toxic, toxic), (with_clean, clean), (toxic - with_toxic, toxic), (clean - with_clean, clean)):
        column = with_toxic + with_clean if seen is with_toxic or seen is with_clean else total - with_toxic - with_clean
        expected = column * all_ / total
        out += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)
    return np.where(with_toxic * clean > with_clean * toxic, out, 0.0)


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> Scorer:
    """Scorer from ``labels`` (doc_id, toxic 0 or 1) and the texts of ``docs`` (doc_id, text).

    A sample of at most SAMPLE_ROWS labels is read; its ids are few enough to be broadcast. Without
    both labels in it every text gets the share of toxic rows (0 without any row).
    """
    rows = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    total = rows.count()
    part = min(1.0, 0.97 * SAMPLE_ROWS / max(total, 1))
    draw = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)
    drawn = stored(rows.withColumn("draw", draw).filter(F.col("draw") < part).drop("draw").limit(SAMPLE_ROWS))
    texts = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    sample = stored(texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic").limit(2 * SAMPLE_ROWS))
    found = sample.mapInArrow(_sample_features(model, None), "toxic int, marks array<long>").toArrow()
    y = np.array(found.column("toxic").to_pylist(), dtype=float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Scorer(model, {}, math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    lists = found.column("marks").combine_chunks()
    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    marks, at = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(y)), sizes)
    toxic_rows = np.bincount(at, weights=y[row], minlength=len(marks))
    all_rows = np.bincount(at, minlength=len(marks))
    strength = evidence(toxic_rows, all_rows - toxic_rows, int(y.sum()), int(len(y) - y.sum()))
    strength[all_rows < LEAST_ROWS] = 0
    chosen = np.argsort(-strength, kind="stable")[:MOST_FEATURES]
    chosen = chosen[strength[chosen] >= EVIDENCE]
    place = np.full(len(marks), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[at] >= 0
    weights, offset = _regression(row[keep], place[at[keep]], len(chosen), y)
    wanted = frozenset(marks[chosen].tolist())
    names = sample.mapInArrow(_sample_features(model, wanted), "mark long, feature string").distinct().collect()
    by_mark = dict(zip(marks[chosen].tolist(), weights.tolist(), strict=True))
    return Scorer(model, {r["feature"]: by_mark[r["mark"]] for r in names}, offset)


def _regression(
    row: np.ndarray, column: np.ndarray, width: int, y: np.ndarray, penalty: float = 0.3, steps: int = 300
) -> tuple[np.ndarray, float]:
    """Logistic regression on features that are there or not, with a square penalty.

    ``row`` and ``column`` say where. Accelerated gradient steps; each is two sums over these places.
    """
    weights, offset = np.zeros(width), math.log(y.mean() / (1 - y.mean()))
    fast_w, fast_o = weights.copy(), offset
    # No feature sum moves faster than the largest row and the offset allow.
    rate = 1.0 / (np.bincount(row, minlength=len(y)).max(initial=0) + 1) / max(1.0, len(y) / 200)
    for step in range(steps):
        sums = np.bincount(row, weights=fast_w[column], minlength=len(y)) + fast_o
        error = 1 / (1 + np.exp(-np.clip(sums, -30, 30))) - y
        slope = np.bincount(column, weights=error[row], minlength=width) + penalty * fast_w
        new_w, new_o = fast_w - rate * slope, fast_o - rate * error.sum()
        pull = step / (step + 3)
        fast_w, fast_o = new_w + pull * (new_w - weights), new_o + pull * (new_o - offset)
        weights, offset = new_w, new_o
    return weights, float(offset)


def _score(scorer: Scorer):
    words = {f for f in scorer.weights if not f.endswith("*")}
    four = {f[:-1] for f in scorer.weights if f.endswith("*") and len(f) == 5}
    five = {f[:-1] for f in scorer.weights if f.endswith("*") and len(f) == 6}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(scorer.model)
        for batch in batches:
            out = []
            for text in _texts(batch.column("text"), restorer):
                own = set(_WORD.findall(text))
                total = scorer.offset
                for word in own & words:
                    total += scorer.weights[word]
                for start in {w[:4] for w in own if len(w) > 4} & four:
                    total += scorer.weights[start + "*"]
                for start in {w[:5] for w in own if len(w) > 5} & five:
                    total += scorer.weights[start + "*"]
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id, score`` of every row, by its whole restored text.

    A null or empty text gets the score of a text without any telling word. Repeated rows get equal
    scores; an empty table stays empty.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return base.mapInArrow(_score(scorer), "doc_id long, score double")


def _restored(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            texts = list(_texts(batch.column("text"), restorer))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "restored"])

    return run


def restore_documents(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id, restored``: every text in lower case without disguises."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return base.mapInArrow(_restored(model), "doc_id long, restored string")
