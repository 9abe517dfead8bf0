"""Benchmark passages in documents, with a bounded number of edits.

Documents and items are sequences of words (runs of letters and digits, in lower case). A document
holds an item of n words if some run of its words is at most ``edits(n)`` word edits away from it.

1. *Embedding.* A walk over the words writes the current word at each step and moves on or stays,
   as a random bit of step and word says. Sequences a few edits apart fall into step again soon after
   an edit, so edit distance becomes Hamming distance of the written strings.
2. *Sampling.* Each of REPEATS walks keeps some of its places, fewer of longer items, whose walks are in
   step on a smaller share of their way; windows and items that agree on them are candidates. Windows start at every word, are as long as the items of their length class, and
   are taken where they share as many runs of words with the benchmark as the distance demands (an
   item loses at most GRAM of its runs to an edit), which loses none.
3. *Verification.* The exact edit distance of the item to the best run of words around the window.

The benchmark is read in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm import hashing
from dwellspark.llm.held import forget
from dwellspark.llm.tables import whole_text

#: Edits allowed per hundred words; items below SHORT words must occur as they are.
PERCENT, SHORT = 20, 6
GRAM = 3
#: Walks of an item; recall of items at the limit is measured in the tests, length by length.
REPEATS = 16
#: Places that are kept of a walk, by the most words of an item that keeps so many.
SAMPLES = ((16, 3), (60, 2))
#: Bytes of items that are looked for in one pass.
BLOCK_BYTES = 8 << 20
#: Next length class: so many percent longer.
CLASS_PERCENT = 130
#: Bits of the first look at a run of words.
FILTER_BITS = 22

SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
FOLD = hashing.fold_table()


def edits(words: int) -> int:
    return words * PERCENT // 100 if words >= SHORT else 0


def samples(size: int) -> int:
    return next((kept for words, kept in SAMPLES if size <= words), 1)


def word_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for j in range(size):
        total += hashes[j : j + len(total)] * hashing.MULTIPLIERS[16 + j]
    return hashing.mix(total + np.uint64(size))


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def walk(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int, repeat: int) -> Iterator[np.ndarray]:
    """The word written at each step by walks that begin at ``starts``; 0 past an end."""
    at = starts.copy()
    salt = hashing.mix(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64(1_000_003 * (repeat + 1)))
    for step in range(steps):
        inside = at < ends
        now = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        yield now
        at += ((now ^ salt[step]) * np.uint64(hashing.BASE) >> np.uint64(63)).astype(np.int64) & 1


def signatures(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int, repeat: int) -> np.ndarray:
    """Sampled places of one walk over the first ``size`` words, as one number."""
    ends = np.minimum(ends, starts + size)
    rng = np.random.default_rng(1000 * size + repeat)
    steps = max(2 * size - 1, 1)
    places = np.sort(rng.choice(steps, min(samples(size), steps), replace=False))
    total = np.full(len(starts), np.uint64(repeat))
    last = int(places[-1]) + 1
    for step, now in enumerate(walk(words, starts, ends, last, repeat)):
        if step in places:
            total = hashing.mix(total + now * hashing.MULTIPLIERS[step % 61])
    return total


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits that turn ``item`` into a run of ``text``, and where that run ends."""
    index = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - index) + index
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class LengthClass:
    """Items of similar length with the signatures of their first ``size`` words for each walk."""

    size: int
    longest: int
    gram: int
    needed: int
    grams: np.ndarray
    known: np.ndarray
    signatures: list[tuple[np.ndarray, np.ndarray]]


class Index:
    def __init__(self, ids: list[int], items: list[np.ndarray]) -> None:
        self.ids, self.items = ids, items
        self.classes: list[LengthClass] = []
        order = sorted((i for i in range(len(items)) if len(items[i])), key=lambda i: len(items[i]))
        at = 0
        while at < len(order):
            size = len(items[order[at]])
            top = size if size < SHORT else max(size, size * CLASS_PERCENT // 100)
            members = []
            while at < len(order) and len(items[order[at]]) <= top:
                members.append(order[at])
                at += 1
            self.classes.append(self._class(size, members))

    def _class(self, size: int, members: list[int]) -> LengthClass:
        lengths = [len(self.items[i]) for i in members]
        gram = GRAM if size >= SHORT else size
        needed = min(n - gram + 1 - gram * edits(n) for n in lengths)
        words = np.concatenate([self.items[i] for i in members])
        ends = np.cumsum(lengths)
        starts = ends - np.array(lengths)
        found = []
        for repeat in range(REPEATS if size >= SHORT else 1):
            own = signatures(words, starts, ends, size, repeat)
            by = np.argsort(own, kind="stable")
            found.append((own[by], np.array(members)[by]))
        grams = np.unique(np.concatenate([word_runs(self.items[i], gram) for i in members]))
        known = np.zeros(1 << FILTER_BITS, bool)
        known[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        longest = max(n + edits(n) for n in lengths)
        return LengthClass(size, longest, gram, max(needed, 1), grams, known, found)

    def search(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], int]:
        """Edits of every (text, item) that is found; words of all texts with each text's bounds."""
        best: dict[tuple[int, int], int] = {}
        if not len(words):
            return best
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        runs: dict[int, np.ndarray] = {}
        for own in self.classes:
            if own.gram not in runs:
                runs[own.gram] = word_runs(words, own.gram)
            starts = self._windows(own, runs[own.gram], text_of, bounds)
            if not len(starts):
                continue
            pairs = self._candidates(own, words, starts, bounds[text_of[starts] + 1])
            for (text, item), at in self._areas(pairs, text_of).items():
                found = self._verify(words, bounds, text, item, at)
                if found is not None:
                    best[text, item] = min(found, best.get((text, item), found))
        return best

    def _windows(self, own: LengthClass, runs: np.ndarray, text_of: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of windows with as many known runs of words as an item within its edits must share."""
        seen = np.flatnonzero(own.known[(runs >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.searchsorted(own.grams, runs[seen])
        seen = seen[own.grams[np.minimum(at, len(own.grams) - 1)] == runs[seen]]
        # A run that reaches into the next text is none.
        seen = seen[text_of[seen] == text_of[seen + own.gram - 1]]
        if len(seen) < own.needed:
            return np.zeros(0, np.int64)
        last = np.searchsorted(seen, seen + own.longest, side="left")
        dense = seen[last - np.arange(len(seen)) >= own.needed]
        # The window may begin before its first known run, by the words that the edits may spoil.
        reach = (own.longest - own.size) + GRAM * edits(own.longest) + 1
        starts = np.unique((dense[:, None] - np.arange(reach)[None, :]).ravel())
        starts = starts[starts >= 0]
        ahead = np.searchsorted(seen, starts + own.longest, side="left") - np.searchsorted(seen, starts, side="left")
        return starts[ahead >= own.needed]

    def _candidates(self, own: LengthClass, words, starts, ends) -> np.ndarray:
        out = []
        for repeat, (known, members) in enumerate(own.signatures):
            mine = signatures(words, starts, ends, own.size, repeat)
            low, high = np.searchsorted(known, mine, side="left"), np.searchsorted(known, mine, side="right")
            hit = np.flatnonzero(high > low)
            for i in hit:
                out += [(starts[i], m) for m in members[low[i] : high[i]]]
        return np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)

    def _areas(self, pairs: np.ndarray, text_of: np.ndarray) -> dict[tuple[int, int], list[int]]:
        areas: dict[tuple[int, int], list[int]] = {}
        for start, item in pairs.tolist():
            areas.setdefault((int(text_of[start]), item), []).append(start)
        return areas

    def _verify(self, words, bounds, text: int, item: int, starts: list[int]) -> int | None:
        own, allowed, best = self.items[item], edits(len(self.items[item])), None
        first = last = starts[0]
        for start in [*starts[1:], None]:
            if start is not None and start - last <= len(own):
                last = start
                continue
            low = max(int(bounds[text]), first - allowed)
            high = min(int(bounds[text + 1]), last + len(own) + 2 * allowed)
            found, _ = distance(own, words[low:high])
            if found <= allowed and (best is None or found < best):
                best = found
            first = last = start
        return best


def _item_words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for group in hashing.groups(lower(pa.array(texts, pa.string()))):
        found = hashing.words(group, SEPARATOR, FOLD)
        out += [found.hashes[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True)]
    return out


def _search(ids: list[int], texts: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("item_words", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        index = Index(ids, _item_words(texts))
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            rows = []
            for group in hashing.groups(lower(batch.column("text"))):
                found = hashing.words(group, SEPARATOR, FOLD)
                for (text, item), count in index.search(found.hashes, found.bounds).items():
                    rows.append((docs[group.first + text], index.ids[item], count, len(index.items[item])))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, edits, item_words``: every item that a document holds, with its least edits.

    Items and texts without a word are in nothing and hold nothing; null ids are kept as they are;
    repeated rows give one row per pair of ids; empty tables give no row.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text(F.col("text")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted({(r["item_id"], r["text"]) for r in rows}, key=str)
        found = base.mapInArrow(
            _search([i for i, _ in rows], [t for _, t in rows]), "doc_id long, item_id long, edits int, item_words int"
        )
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.min("item_words").alias("item_words"))
