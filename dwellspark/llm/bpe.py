"""Encoding and decoding with a public BPE vocabulary; long texts by tree concatenation.

A long text is cut into leaves that are encoded in parallel. Neighbouring halves are joined, level by
level: a window around the cut is encoded again, and it grows until its tokens agree with the left
half on one side and with the right half on the other. Then the window replaces the tokens between.

Agreement is an equal token boundary at the end of a word on both sides, since the word splitter
looks at nothing before such a boundary; inside a word without any boundary it is a run of equal
tokens. If there is no agreement, the window grows to the whole of both halves, which is the plain
encoding. Inside a leaf, words between white space are independent of each other; their ids are
remembered per Python worker, so a word is encoded once and not once per occurrence.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.held import held
from dwellspark.llm.tables import stored, whole_text

#: Characters of a leaf; longer texts are cut.
LEAF_CHARS = 65_536
#: Characters on each side of a cut in the first window.
FIRST_WINDOW = 64
#: Equal tokens that count as agreement inside a word.
RUN = 16
#: Bytes that a worker's memory of words and pieces may take, what an entry of it takes besides its
#: characters, and characters of a word above which it is encoded each time.
REMEMBERED, ENTRY, LONG_WORD = 64 << 20, 220, 200
#: Bytes of text whose words are looked up together, and pieces that are encoded together. A worker
#: keeps what the largest group once took, which is many times these bytes.
GROUP_BYTES, BATCH = 1 << 19, 4096
#: Words not found, as a multiple of those remembered, after which a memory starts anew.
RENEWED = 8
WORD_END = "</w>"
#: Fixed value: how the vocabulary's splitter cuts a word without white space.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Characters that Python counts as white space and the vocabulary's normaliser may not.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


@dataclass
class Codec:
    """A vocabulary with what this worker has encoded so far."""

    path: str
    words: dict[str, bytes] = field(default_factory=dict)
    pieces: dict[str, bytes] = field(default_factory=dict)
    held: int = 0
    missed: int = 0

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.tokens[i] = token
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = regex.compile("|".join(regex.escape(t.content) for t in added) or r"(?!)")
        probe = self.tokenizer.encode("a, b", add_special_tokens=False).ids
        plain = " ".join(self.tokens[i] for i in probe)
        self.joins = self.tokenizer.decode(probe, skip_special_tokens=False) == plain

    def ids(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Words that are not remembered are encoded once for all of the texts."""
        plain = [None if ODD_SPACE.search(t) or self.special.search(t) else t.split() for t in texts]
        known = self.words
        missing = {w for words in plain if words is not None for w in words} - known.keys()
        new, pieces = self.learn(missing) if missing else ({}, {})
        known.update(new)
        lookup = known.__getitem__
        out = [
            self.directly(t) if words is None else b"".join(map(lookup, words))
            for t, words in zip(texts, plain, strict=True)
        ]
        for word in new:
            del known[word]
        self.remember(new, pieces)
        return out

    def remember(self, words: dict[str, bytes], pieces: dict[str, bytes]) -> None:
        """Adds to the memory while there is room.

        Frequent words come early, so a full memory stays as it is. It starts anew when so many words
        were not in it that the texts are likely to have become others.
        """
        for memory, new in ((self.words, words), (self.pieces, pieces)):
            self.missed += len(new)
            for key, ids in new.items():
                size = len(key) + len(ids) + ENTRY
                if self.held + size > REMEMBERED:
                    break
                if len(key) <= LONG_WORD:
                    memory[key] = ids
                    self.held += size
        if self.missed > RENEWED * (len(self.words) + len(self.pieces) + 1):
            self.words.clear()
            self.pieces.clear()
            self.held = self.missed = 0

    def directly(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of words that are not remembered, and of their pieces that are not."""
        out: dict[str, bytes] = {}
        cut: dict[str, list[str]] = {}
        for word in words:
            # Beyond Latin letters, lower case and composition are left to the tokenizer itself.
            if word.isascii() or (max(word) < "İ" and unicodedata.is_normalized("NFC", word)):
                cut[word] = PIECES.findall(word.lower())
            else:
                out[word] = self.directly(word)
        known = self.pieces
        missing = list({p for parts in cut.values() for p in parts if p not in known})
        new: dict[str, bytes] = {}
        for i in range(0, len(missing), BATCH):
            part = missing[i : i + BATCH]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            new.update((p, np.array(x.ids, "<u4").tobytes()) for p, x in zip(part, found, strict=True))
        for word, parts in cut.items():
            out[word] = b"".join([known[p] if p in known else new[p] for p in parts])
        return out, new

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.joins:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


def codec(path: str) -> Codec:
    return held(f"bpe {path}", lambda: Codec(path))


@dataclass
class Half:
    """Tokens of text[start:end]; ends: where each token ends in the whole text."""

    start: int
    end: int
    ids: np.ndarray
    ends: np.ndarray


def encode_range(own: Codec, text: str, start: int, end: int) -> Half:
    found = own.tokenizer.encode(text[start:end], add_special_tokens=False)
    ends = np.array([b for _, b in found.offsets], dtype=np.int64) + start
    return Half(start, end, np.array(found.ids, dtype=np.uint32), ends)


def _left_match(own: Codec, left: Half, window: Half) -> tuple[int, int] | None:
    """Numbers of tokens of ``left`` and of ``window`` before a boundary on which they agree."""
    where = {int(e): i for i, e in enumerate(left.ends) if e < left.end}
    run = 0
    for j, (token, end) in enumerate(zip(window.ids.tolist(), window.ends.tolist(), strict=True)):
        i = where.get(end)
        run = run + 1 if i is not None and left.ids[i] == token else 0
        if run and own.tokens[token].endswith(WORD_END):
            return i + 1, j + 1
        if run == RUN:
            return i + 1 - RUN // 2, j + 1 - RUN // 2
    return None


def _right_match(own: Codec, right: Half, window: Half) -> tuple[int, int] | None:
    """The same for ``right``, from the end of the window."""
    where = {int(e): i for i, e in enumerate(right.ends)}
    run = 0
    for j in range(len(window.ids) - 1, -1, -1):
        token = int(window.ids[j])
        i = where.get(int(window.ends[j]))
        run = run + 1 if i is not None and right.ids[i] == token else 0
        if run and own.tokens[token].endswith(WORD_END):
            return i + 1, j + 1
        if run == RUN:
            return i + RUN // 2, j + RUN // 2
    return None


def join_halves(own: Codec, text: str, left: Half, right: Half) -> Half:
    """Tokens of both halves together, as encoding text[left.start:right.end] gives them."""
    reach, cut = FIRST_WINDOW, left.end
    while True:
        start, end = max(left.start, cut - reach), min(right.end, cut + reach)
        window = encode_range(own, text, start, end)
        a = (0, 0) if start == left.start else _left_match(own, left, window)
        b = (len(right.ids), len(window.ids)) if end == right.end else _right_match(own, right, window)
        if a is not None and b is not None and a[1] <= b[1]:
            return Half(
                left.start,
                right.end,
                np.concatenate([left.ids[: a[0]], window.ids[a[1] : b[1]], right.ids[b[0] :]]),
                np.concatenate([left.ends[: a[0]], window.ends[a[1] : b[1]], right.ends[b[0] :]]),
            )
        if start == left.start and end == right.end:
            return window
        reach *= 2


def concatenate(own: Codec, text: str, leaves: list[Half]) -> np.ndarray:
    """Joins neighbouring halves, level by level."""
    while len(leaves) > 1:
        pairs = [leaves[i : i + 2] for i in range(0, len(leaves), 2)]
        leaves = [join_halves(own, text, *p) if len(p) == 2 else p[0] for p in pairs]
    return leaves[0].ids


def _digest(own: Codec, ids: bytes) -> tuple[int, str, str]:
    decoded = own.decode(ids).encode("utf-8")
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with about GROUP_BYTES of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + GROUP_BYTES, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _short(path: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in _groups(batch):
                coded = own.ids_of(part.column("text").to_pylist())
                yield _rows(own, part.column("doc_id"), coded, full)

    return run


def _rows(own: Codec, doc_ids: pa.Array, coded: list[bytes], full: bool) -> pa.RecordBatch:
    counts, sums, texts = zip(*(_digest(own, ids) for ids in coded), strict=True) if coded else ((), (), ())
    columns = {
        "doc_id": doc_ids,
        "n_tokens": pa.array(counts, pa.int64()),
        "ids_sha256": pa.array(sums, pa.string()),
        "decoded_sha256": pa.array(texts, pa.string()),
    }
    if full:
        columns["ids"] = pa.array([np.frombuffer(i, "<u4").astype("<i8") for i in coded], pa.list_(pa.int64()))
        columns["decoded"] = pa.array([own.decode(i) for i in coded], pa.string())
    return pa.RecordBatch.from_pydict(columns)


def _leaf(path: str):
    schema = pa.schema(
        [("row", pa.int64()), ("leaf", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("ids", pa.binary()), ("ends", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = batch.to_pylist()
            halves = [encode_range(own, r["piece"], 0, len(r["piece"])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["row"] for r in rows], pa.int64()),
                    pa.array([r["leaf"] for r in rows], pa.int32()),
                    pa.array([r["start"] for r in rows], pa.int64()),
                    pa.array([r["start"] + len(r["piece"]) for r in rows], pa.int64()),
                    pa.array([h.ids.astype("<u4").tobytes() for h in halves], pa.binary()),
                    pa.array([(h.ends + r["start"]).astype("<i8").tobytes() for h, r in zip(halves, rows, strict=True)], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _long(path: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for r in batch.to_pylist():
                leaves = [
                    Half(x["start"], x["end"], np.frombuffer(x["ids"], "<u4"), np.frombuffer(x["ends"], "<i8"))
                    for x in sorted(r["leaves"], key=lambda x: x["leaf"])
                ]
                ids = concatenate(own, r["text"], leaves).astype("<u4").tobytes()
                yield _rows(own, pa.array([r["doc_id"]], pa.int64()), [ids], full)

    return run


def encode_documents(
    docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, with_values: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text; with ``ids`` and ``decoded`` on demand.

    A null text counts as an empty one: no token and the digests of nothing. Repeated rows are rows
    of their own and an empty table stays empty. Texts of up to ``leaf_chars`` characters are encoded
    where they are read; longer ones are cut, their leaves spread over the tasks, and put together
    per text, so one task never holds more than the tokens of one long text.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out += ", ids array<long>, decoded string" if with_values else ""
    is_long = F.length("text") > leaf_chars
    short = base.filter(~is_long).mapInArrow(_short(path, with_values), out)
    long = stored(base.filter(is_long).withColumn("row", F.monotonically_increasing_id()))
    number = F.ceil(F.length("text") / F.lit(leaf_chars)).cast("int")
    cut = long.select("row", "text", F.explode(F.sequence(F.lit(0), number - 1)).alias("leaf")).select(
        "row",
        "leaf",
        (F.col("leaf").cast("long") * leaf_chars).alias("start"),
        F.substring("text", F.col("leaf") * leaf_chars + 1, F.lit(leaf_chars)).alias("piece"),
    )
    leaves = (
        cut.repartition("row", "leaf")
        .mapInArrow(_leaf(path), "row long, leaf int, start long, end long, ids binary, ends binary")
        .groupBy("row")
        .agg(F.collect_list(F.struct("leaf", "start", "end", "ids", "ends")).alias("leaves"))
    )
    merged = long.join(leaves, "row").select("doc_id", "text", "leaves").mapInArrow(_long(path, with_values), out)
    return short.unionByName(merged)
