"""Repeated byte strings by a sorted array of suffixes.

Every byte that is covered by a string of ``length`` bytes which starts at two places is removed.

*Which suffixes are sorted.* Each window of ``length`` bytes names one anchor: its smallest run of GRAM
bytes by hash, the leftmost of equals. Equal windows name the same anchor, so a window can only repeat
if its anchor's run of bytes does. An anchor's context is everything that a window around it can
reach. Where the whole context occurs twice, all windows around the anchor repeat and nothing need be
sorted. What is left are windows around anchors whose run repeats in another context. They begin on
one of two sides of it: far ahead, or close by. All windows of a side have a core in common, and only
sides whose core repeats go on, with one copy of each repeated context beside them.

*How they are sorted.* Sampled splitters range-partition the suffixes by their leading token, the core.
Each bucket sorts its suffixes locally, one key after the other as multikey quicksort does: those of
a core by their hash. Equal neighbours repeat. A core may lie in several buckets, so the suffixes of
the first and last core of each bucket are compared with those of other buckets; a hot string is
spread, not gathered.

The texts are exchanged once; their uses after that share the exchange.

*Passages of words.* On request a passage also repeats if its words do, whatever white space is between
them and however few bytes they have. Windows of so many words name their anchor, their smallest run of
WORD_GRAM words by hash, and windows around anchors that repeat are sorted by the same buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm import hashing
from dwellspark.llm.held import forget
from dwellspark.llm.tables import stored, whole_text

LENGTH = 400
#: Bytes of an anchor.
GRAM = 32
#: Words of an anchor, and what is between words.
WORD_GRAM = 8
SEPARATOR, FOLD = hashing.byte_set(0x20, range(0x09, 0x0E)), hashing.fold_table(upper=False)
#: A gram is hot from this share of the anchors (one in SHARES) and this number of them on.
SHARES, LEAST_HOT = 1000, 256
#: Low bits of a key that hold the place; the high bits hold the hash.
PLACE = np.uint64((1 << 28) - 1)


@dataclass
class Scan:
    """Prefix sums of a group of texts and, for every place, the anchor of the window that starts there."""

    sums: np.ndarray
    grams: np.ndarray
    anchors: np.ndarray


def window_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hashing.mix((sums[ends] - sums[starts]) * hashing.powers(hashing.INVERSE, len(sums))[starts])


def scan(data: np.ndarray, length: int) -> Scan | None:
    return _anchored(hashing.prefix_sums(data), length, GRAM) if len(data) >= length else None


def scan_words(found: hashing.Words, length: int) -> Scan | None:
    """The same over words: places are numbers of words."""
    count = len(found.hashes)
    if count < length:
        return None
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(found.hashes * hashing.powers(hashing.BASE, count), out=sums[1:])
    return _anchored(sums, length, WORD_GRAM)


def _anchored(sums: np.ndarray, length: int, gram: int) -> Scan:
    width = length - gram + 1
    count = len(sums) - gram
    grams = hashing.mix((sums[gram:] - sums[:-gram]) * hashing.powers(hashing.INVERSE, count))
    keys = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    keys[:count] = (grams & ~PLACE) | np.arange(count, dtype=np.uint64)
    blocks = keys.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(sums) - length
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    return Scan(sums, grams, (least & PLACE).astype(np.int64))


def side(length: int, number: int) -> tuple[int, int]:
    """Smallest and largest distance from the start of a window to its anchor on a side."""
    half = (length - GRAM + 2) // 2
    return (0, half - 1) if number == 0 else (half, length - GRAM)


def cores(sums: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, number: int) -> np.ndarray:
    """Hash of what all windows of a side have in common; 0 where the text [low, high) is too short."""
    near, far = side(length, number)
    starts, ends = at - near, at - far + length
    out = np.zeros(len(at), np.uint64)
    good = (starts >= low) & (ends <= high)
    out[good] = window_hash(sums, starts[good], ends[good]) ^ hashing.MULTIPLIERS[4 + number]
    return out


def _anchors(length: int):
    names = ["gram", "context", "near", "far", "key", "pos"]
    schema = pa.schema([(n, pa.int64()) for n in names[:-1]] + [("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for group in hashing.groups(batch.column("text")):
                found = scan(group.data, length)
                if found is None:
                    continue
                sizes = np.diff(group.bounds)
                texts, places = [], []
                for i in np.flatnonzero(sizes >= length):
                    own = np.unique(found.anchors[group.bounds[i] : group.bounds[i + 1] - length + 1])
                    texts.append(np.full(len(own), i))
                    places.append(own)
                if not texts:
                    continue
                text, at = np.concatenate(texts), np.concatenate(places)
                first, end = group.bounds[text], group.bounds[text + 1]
                low, high = np.maximum(first, at + GRAM - length), np.minimum(end, at + length)
                shape = (at - low).astype(np.uint64) * np.uint64(1 << 32) + (high - at).astype(np.uint64)
                context = hashing.mix(window_hash(found.sums, low, high) ^ hashing.mix(shape + hashing.MULTIPLIERS[3]))
                columns = [found.grams[at], context, *(cores(found.sums, at, first, end, length, n) for n in (0, 1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(c.view(np.int64)) for c in columns),
                        pa.array(keys[group.first + text]),
                        pa.array((at - first).astype(np.int32)),
                    ],
                    schema=schema,
                )

    return run


def _suffixes(length: int):
    """For each wanted side of an anchor a row with the hashes of its windows."""
    schema = pa.schema([("core", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            wanted = batch.column("places")
            offsets, flat = wanted.offsets.to_numpy(), wanted.flatten()
            pos, number, core = (flat.field(n).to_numpy() for n in ("pos", "side", "core"))
            offsets = offsets - offsets[0]
            keys = batch.column("key").to_numpy()
            data, bounds = hashing.buffers(batch.column("text"))
            for i in range(len(batch)):
                text = data[bounds[i] : bounds[i + 1]]
                found = scan(text, length)
                if found is None:
                    continue
                rows = slice(offsets[i], offsets[i + 1])
                cut, starts = [], []
                for at, which in zip(pos[rows].tolist(), number[rows].tolist(), strict=True):
                    near, far = side(length, which)
                    first = max(0, at - far)
                    own = first + np.flatnonzero(found.anchors[first : max(first, at - near + 1)] == at)
                    starts.append(int(own[0]) if len(own) else 0)
                    cut.append(window_hash(found.sums, own, own + length).tobytes())
                keep = [j for j, c in enumerate(cut) if c]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core[rows][keep]),
                        pa.array(np.full(len(keep), keys[i])),
                        pa.array(np.array(starts, np.int32)[keep]),
                        pa.array([cut[j] for j in keep], pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _word_anchors(length: int):
    schema = pa.schema([("gram", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for group in hashing.groups(batch.column("text")):
                words = hashing.words(group, SEPARATOR, FOLD)
                found = scan_words(words, length)
                if found is None:
                    continue
                bounds = words.bounds
                texts = np.repeat(np.arange(len(bounds) - 1), np.maximum(np.diff(bounds) - length + 1, 0))
                if not len(texts):
                    continue
                # Anchors of a text ascend with its windows, so equal ones are neighbours.
                starts = np.flatnonzero(np.diff(texts, prepend=-1))
                at = found.anchors[bounds[texts] + np.arange(len(texts)) - np.repeat(starts, np.diff(starts, append=len(texts)))]
                new = np.append(True, (at[1:] != at[:-1]) | (texts[1:] != texts[:-1]))
                at, texts = at[new], texts[new]
                own = [found.grams[at].view(np.int64), keys[group.first + texts], (at - bounds[texts]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in own], schema=schema)

    return run


def _word_windows(length: int):
    """For each wanted anchor a row with the hashes of its windows, as ``_suffixes`` gives them."""
    schema = pa.schema([("core", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            wanted = batch.column("places")
            offsets, flat = wanted.offsets.to_numpy(), wanted.flatten()
            pos, gram = (flat.field(n).to_numpy() for n in ("pos", "gram"))
            offsets = offsets - offsets[0]
            keys = batch.column("key").to_numpy()
            data, bounds = hashing.buffers(batch.column("text"))
            for i in range(len(batch)):
                text = data[bounds[i] : bounds[i + 1]]
                found = scan_words(hashing.words(hashing.Group(0, text, np.array([0, len(text)])), SEPARATOR, FOLD), length)
                if found is None:
                    continue
                rows = slice(offsets[i], offsets[i + 1])
                starts, cut = [], []
                for at in pos[rows].tolist():
                    first = max(0, at - length + WORD_GRAM)
                    own = first + np.flatnonzero(found.anchors[first : at + 1] == at)
                    starts.append(int(own[0]))
                    cut.append(window_hash(found.sums, own, own + length).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[rows]),
                        pa.array(np.full(len(cut), keys[i])),
                        pa.array(np.array(starts, np.int32)),
                        pa.array(cut, pa.binary()),
                    ],
                    schema=schema,
                )

    return run


#: A run of repeated starts of a text, or (edge) one suffix of a bucket's first or last core.
MARKS = pa.schema(
    [("edge", pa.int32()), ("bucket", pa.int32()), ("core", pa.int64()), ("hash", pa.int64()), ("key", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]
)


def _compared(columns: list, edges: set[int], bucket: int) -> Iterator[pa.RecordBatch]:
    """Marks of rows (core, key, start, windows) that hold whole cores of a bucket."""
    core, key, start, windows = columns
    counts = np.array([len(w) // 8 for w in windows])
    hashes = np.frombuffer(b"".join(windows), np.uint64)
    row = np.repeat(np.arange(len(core)), counts)
    at = start[row] + np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.lexsort((hashes, core[row]))
    same = (core[row][order][1:] == core[row][order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    # Neighbouring starts of a text become one run.
    hit = np.flatnonzero(twice)
    begins = np.ones(len(hit), bool)
    begins[1:] = (row[hit][1:] != row[hit][:-1]) | (hit[1:] != hit[:-1] + 1)
    ends = np.append(begins[1:], True) if len(hit) else begins
    low, high = at[hit[begins]], at[hit[ends]]
    n = len(low)
    zero = pa.array(np.zeros(n, np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, bucket, np.int32)), pa.array(low.astype(np.int64)), zero,
         pa.array(key[row[hit[begins]]]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
        schema=MARKS,
    )
    first = np.ones(len(order), bool)
    first[1:] = ~same
    some = order[first & np.isin(core[row][order], list(edges))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(some), np.int32)), pa.array(np.full(len(some), bucket, np.int32)), pa.array(core[row[some]]), pa.array(hashes[some].view(np.int64)),
         pa.array(key[row[some]]), pa.array(at[some].astype(np.int32)), pa.array(at[some].astype(np.int32))],
        schema=MARKS,
    )


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket sorted by core: its marks, core by core."""
    bucket = TaskContext.get().partitionId()
    held, leading = None, None
    for batch in batches:
        if not len(batch):
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("core", "key", "start", "windows")]
        if held is not None:
            now = [np.concatenate([h, c]) for h, c in zip(held, now, strict=True)]
        leading = int(now[0][0]) if leading is None else leading
        whole = int(np.searchsorted(now[0], now[0][-1], side="left"))
        if whole:
            yield from _compared([c[:whole] for c in now], {leading}, bucket)
        held = [c[whole:] for c in now]
    if held is not None:
        yield from _compared(held, {leading, int(held[0][0])}, bucket)


def _repeated_starts(suffixes: DataFrame) -> DataFrame:
    """``key, low, high``: runs of starts whose strings of ``length`` bytes occur twice."""
    order = ["core", "key", "start"]
    buckets = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    marks = buckets.mapInArrow(_bucket, "edge int, bucket int, core long, hash long, key long, low int, high int")
    # A bucket gives each suffix of an edge once, so these groups are no larger than the number of
    # buckets. Runs that are known to repeat pass as groups of their own.
    group = Window.partitionBy("edge", "core", "hash", F.when(F.col("edge") == 0, F.col("key")))
    met = marks.withColumn("lo", F.min("bucket").over(group)).withColumn("hi", F.max("bucket").over(group))
    return met.filter((F.col("edge") == 0) | (F.col("lo") != F.col("hi"))).select("key", "low", "high")


def _in_parts(anchors: DataFrame, groups: DataFrame, key: str, most: int) -> DataFrame:
    """``anchors`` (with ``place``) joined with the row of their group; ``groups`` has the key and ``n``.

    A group of more than ``most`` anchors is cut into parts by the place of the anchor, and its row comes
    once per part, so no task gets all anchors of a common line. ``most`` is a share of all anchors, so
    few groups are that large: what is broadcast has SHARES rows at most.
    """
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = groups.filter(F.col("n") > most).select(key, parts.alias("parts"))
    part = F.coalesce(F.pmod("place", F.col("parts")).cast("int"), F.lit(0)).alias("part")
    left = anchors.join(F.broadcast(hot), key, "left").select(*anchors.columns, part)
    right = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return left.join(right.drop("n"), [key, "part"]).drop("part")


def _again(anchors: DataFrame) -> tuple[DataFrame, int]:
    """``gram, n`` of the grams of several places, and from how many anchors on a group is cut into parts.

    Copies of a text count as often as they are there; ``n`` only says into how many parts a group is cut.
    """
    place = F.xxhash64("key", "pos")
    again = stored(
        anchors.groupBy("gram")
        .agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n"))
        .filter(F.col("lo") != F.col("hi"))
        .select("gram", "n")
    )
    return again, max(LEAST_HOT, (again.agg(F.sum("n")).first()[0] or 0) // SHARES)


def repeated_words(texts: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    """``key, low, high``: runs of words at which passages of ``length`` words start that start elsewhere, too.

    ``anchors`` is what ``_word_anchors`` makes of the texts.
    """
    again, most = _again(anchors)
    placed = anchors.distinct().withColumn("place", F.xxhash64("key", "pos"))
    wanted = (
        _in_parts(placed, again, "gram", most)
        .groupBy("key")
        .agg(F.collect_list(F.struct("pos", "gram")).alias("places"))
        .join(texts.groupBy("key").agg(F.min("row").alias("row")), "key")
    )
    held = texts.join(wanted.select("row", "places"), "row")
    return _repeated_starts(held.mapInArrow(_word_windows(length), "core long, key long, start int, windows binary"))


def repeated_ranges(
    texts: DataFrame, anchors: DataFrame, length: int = LENGTH, passages: DataFrame | None = None
) -> DataFrame:
    """``row, ranges, passages, copies``: first and last starts of repeated strings, and of ``passages`` in words.

    ``anchors`` is what ``_anchors`` makes of the texts. ``texts`` has ``row`` (a hash of id and text), ``key`` (a hash of the text) and ``text``. Where
    several rows have a text, ``copies`` is true: all of it repeats, if it has ``length`` bytes.
    """
    rows = texts.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("rows"))
    twice = F.col("lo") != F.col("hi")
    place = F.xxhash64("key", "pos")
    lowest, highest = F.min("place").alias("lo"), F.max("place").alias("hi")
    again, most = _again(anchors)
    # Copies of a text have the same anchors; each stays once.
    placed = anchors.distinct().withColumn("place", place)
    shared = stored(_in_parts(placed, again, "gram", most).drop("gram", "place")).withColumn("place", place)
    contexts = shared.groupBy("context").agg(lowest, highest, F.count("*").alias("n"))
    known = _in_parts(shared, contexts, "context", most).withColumn("torn", ~twice)
    inner = known.filter(twice).select("key", (F.col("pos") + GRAM - length).alias("low"), F.col("pos").alias("high"))
    sides = (
        known.filter(F.col("place") == F.col("lo"))
        .select("key", "place", "pos", "torn", F.posexplode(F.array("near", "far")).alias("side", "core"))
        .filter(F.col("core") != 0)
    )
    active = sides.groupBy("core").agg(lowest, highest, F.max("torn").alias("some")).filter(twice & F.col("some"))
    wanted = (
        sides.join(active.select("core"), "core")
        .groupBy("key")
        .agg(F.collect_list(F.struct("pos", "side", "core")).alias("places"))
        .join(rows.select("key", "row"), "key")
    )
    held = texts.join(wanted.select("row", "places"), "row")
    suffixes = held.mapInArrow(_suffixes(length), "core long, key long, start int, windows binary")
    # Of a text with copies all goes, so its ranges are not collected.
    alone = rows.filter(F.col("rows") == 1).select("key", "row")
    found = inner.unionByName(_repeated_starts(suffixes)).withColumn("words", F.lit(False))
    if passages is not None:
        found = found.unionByName(passages.withColumn("words", F.lit(True)))
    run = F.struct("low", "high")
    single = (
        found.join(alone, "key")
        .groupBy("row")
        .agg(
            F.collect_list(F.when(~F.col("words"), run)).alias("ranges"),
            F.collect_list(F.when(F.col("words"), run)).alias("passages"),
        )
        .withColumn("copies", F.lit(False))
    )
    none = F.array().cast("array<struct<low:int,high:int>>")
    many = (
        texts.select("key", "row").join(rows.filter(F.col("rows") > 1).select("key"), "key").select("row").distinct()
    )
    return single.unionByName(
        many.select("row", none.alias("ranges"), none.alias("passages"), F.lit(True).alias("copies"))
    )


def spans(size: int, ranges: np.ndarray, copies: bool, length: int) -> np.ndarray:
    """Maximal removed runs (start, end) of a text of ``size`` bytes."""
    if size < length:
        return np.zeros((0, 2), np.int64)
    if copies:
        return np.array([[0, size]])
    low = np.maximum(ranges[:, 0], 0)
    high = np.minimum(ranges[:, 1], size - length)
    good = low <= high
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, low[good], 1)
    np.add.at(change, high[good] + length, -1)
    covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    return np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)


def _runs(column: pa.Array) -> list[np.ndarray]:
    """Of every row its first and last starts."""
    offsets, flat = column.offsets.to_numpy(), column.flatten()
    pairs = np.stack([flat.field("low").to_numpy(), flat.field("high").to_numpy()], axis=1).astype(np.int64)
    return [pairs[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def passage_spans(text: np.ndarray, ranges: np.ndarray, copies: bool, words: int) -> np.ndarray:
    """Maximal runs of bytes (start, end) that passages of ``words`` words cover."""
    starts = hashing.words(hashing.Group(0, text, np.array([0, len(text)])), SEPARATOR, FOLD).starts
    gone = spans(len(starts), ranges, copies, words)
    gaps = np.append(np.flatnonzero(SEPARATOR[text]), len(text))
    ends = gaps[np.searchsorted(gaps, starts)]
    return np.stack([starts[gone[:, 0]], ends[gone[:, 1] - 1]], axis=1)


def _united(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    both = np.concatenate([one, other])
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    first = np.append(True, both[1:, 0] > reach[:-1])
    return np.stack([both[first, 0], reach[np.append(first[1:], True)]], axis=1)


def _cut(batch: pa.RecordBatch, length: int, words: int | None = None) -> Iterator[tuple[bytes, np.ndarray]]:
    data, bounds = hashing.buffers(batch.column("text"))
    ranges, passages = _runs(batch.column("ranges")), _runs(batch.column("passages"))
    copies = batch.column("copies").to_numpy(zero_copy_only=False)
    for i in range(len(batch)):
        text = data[bounds[i] : bounds[i + 1]]
        gone = spans(len(text), ranges[i], bool(copies[i]), length)
        if words and (len(passages[i]) or copies[i]):
            more = passage_spans(text, passages[i], bool(copies[i]), words)
            gone = _united(gone, more) if len(more) else gone
        yield text.tobytes(), gone


def _digests(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, sums = [], [], [], []
            for text, gone in _cut(batch, length):
                ends = [0, *gone.ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                sizes.append(len(text))
                removed.append(len(text) - len(kept))
                runs.append(len(gone))
                sums.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(runs, pa.int64()),
                    "kept_sha256": pa.array(sums, pa.string()),
                }
            )

    return run


def _kept_texts(length: int, words: int | None):
    """Texts without their repeated strings; a character of which only a part repeats stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in _cut(batch, length, words):
                ends = [0]
                for start, end in gone.tolist():
                    while start < len(text) and text[start] & 0xC0 == 0x80:
                        start += 1
                    while end < len(text) and text[end] & 0xC0 == 0x80:
                        end -= 1
                    ends += [start, max(start, end)]
                ends.append(len(text))
                texts.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array(texts, pa.string())], names=["own", "text"])

    return run


def _with_ranges(docs: DataFrame, length: int, words: int | None = None) -> DataFrame:
    keyed = docs.withColumn("text", whole_text(F.col("text"))).withColumn("key", F.xxhash64("text"))
    anchors = keyed.select("key", "text").mapInArrow(
        _anchors(length), "gram long, context long, near long, far long, key long, pos int"
    )
    # The one exchange of the texts. All columns go along, so that both uses ask for the same.
    keyed = keyed.withColumn("row", F.xxhash64("doc_id", "key")).repartition("row")
    passages = None
    if words:
        named = docs.select(whole_text(F.col("text")).alias("text")).withColumn("key", F.xxhash64("text"))
        passages = repeated_words(keyed, named.mapInArrow(_word_anchors(words), "gram long, key long, pos int"), words)
    found = repeated_ranges(keyed, anchors, length, passages)
    none = F.array().cast("array<struct<low:int,high:int>>")
    return (
        keyed.join(found, "row", "left")
        .withColumn("ranges", F.coalesce("ranges", none))
        .withColumn("passages", F.coalesce("passages", none))
        .withColumn("copies", F.coalesce("copies", F.lit(False)))
    )


def repeat_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A null text is empty; texts of fewer than ``length`` bytes lose nothing; repeated rows are copies
    of each other, so all of them goes if they are long enough; an empty table stays empty.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_ranges(narrow, length).mapInArrow(
        _digests(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` with the same columns and rows, the texts without repeated strings.

    Spans are those of ``repeat_digest``, moved inwards to whole characters. With ``words`` every passage
    of so many words that also starts anywhere else goes, too, from its first word to its last; both are
    judged on the input. A text that loses all is empty; a null text becomes empty.
    """
    # Other columns travel as one, so that none of their names meets one of this module.
    rest = [f for f in docs.schema.fields if f.name != "text"]
    own = F.struct(F.lit(True).alias("_"), *[F.col(f"`{f.name}`") for f in rest])
    packed = docs.select(own.alias("own"), "doc_id", "text")
    cut = _with_ranges(packed, length, words).mapInArrow(_kept_texts(length, words), packed.select("own", "text").schema)
    return cut.select(*[F.col("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns])
