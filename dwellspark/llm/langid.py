"""Language identification by a convolutional network over bytes, trained in numpy.

A text is cut into windows of WINDOW bytes. Each byte has an embedding; filters of several widths
slide over a window, the largest answer of each filter is kept, and a softmax over the languages
follows. Training reads a bounded sample of labelled windows on the driver. For prediction the
filters are folded into tables over byte pairs, so a filter answers with one or two look-ups; the
windows of a batch go through together. All windows of a text count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.llm import hashing
from dwellspark.llm.held import forget
from dwellspark.llm.tables import whole_text

WINDOW = 256
WIDTHS = (2, 3, 4)
#: Filters of each width, and numbers in the embedding of a byte.
FILTERS, EMBEDDING = 24, 8
#: The training sample: windows of all languages together, windows of one text, and languages.
SAMPLE_WINDOWS, TEXT_WINDOWS, LANGUAGES = 16_000, 6, 500
STEPS, BATCH, RATE, SEED = 700, 64, 0.004, 7
#: Windows that go through the network at once.
CHUNK = 96
NO_LANGUAGE = "und"

#: Letters in lower case; what is neither a letter nor part of a longer character is a blank.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


def _patches(x: np.ndarray, width: int) -> np.ndarray:
    n, length, dims = x.shape
    view = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)
    return view.transpose(0, 1, 3, 2).reshape(n, length - width + 1, width * dims)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    """Adam on the cross entropy, classes drawn with equal weight; gradients pass the winning places only."""
    rng = np.random.default_rng(SEED)
    total = FILTERS * len(WIDTHS)
    p = {
        "e": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        "w": rng.normal(0, 0.1, (total, len(languages))).astype(np.float32),
        "b": np.zeros(total, np.float32),
        "o": np.zeros(len(languages), np.float32),
    }
    for width in WIDTHS:
        scale = (2 / (width * EMBEDDING)) ** 0.5
        p[f"k{width}"] = rng.normal(0, scale, (width * EMBEDDING, FILTERS)).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    by_class = [np.flatnonzero(labels == c) for c in range(len(languages))]
    for step in range(1, STEPS + 1 if len(languages) > 1 else 1):
        pick = np.array([rng.choice(by_class[c]) for c in rng.integers(0, len(languages), BATCH)])
        x, y = windows[pick], labels[pick]
        embedded = p["e"][x]
        pooled, kept = [], []
        for width in WIDTHS:
            patches = _patches(embedded, width)
            answers = patches @ p[f"k{width}"]
            at = answers.argmax(axis=1)
            pooled.append(np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0])
            kept.append((at, patches[np.arange(BATCH)[:, None], at]))
        hidden = np.concatenate(pooled, axis=1) + p["b"]
        active = np.maximum(hidden, 0)
        scores = active @ p["w"] + p["o"]
        probability = np.exp(scores - scores.max(axis=1, keepdims=True))
        probability /= probability.sum(axis=1, keepdims=True)
        probability[np.arange(BATCH), y] -= 1
        error = probability / BATCH
        g = {"w": active.T @ error, "o": error.sum(axis=0), "e": np.zeros_like(p["e"])}
        back = (error @ p["w"].T) * (hidden > 0)
        g["b"] = back.sum(axis=0)
        for i, width in enumerate(WIDTHS):
            own, (at, patch) = back[:, i * FILTERS : (i + 1) * FILTERS], kept[i]
            g[f"k{width}"] = np.einsum("nf,nfd->df", own, patch)
            into = (own[:, :, None] * p[f"k{width}"].T[None]).reshape(BATCH, FILTERS, width, EMBEDDING)
            for j in range(width):
                np.add.at(g["e"], x[np.arange(BATCH)[:, None], at + j], into[:, :, j])
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Network(languages, p["e"], [p[f"k{w}"] for w in WIDTHS], p["b"], p["w"], p["o"])


class Tables:
    """The filters of a network as whole numbers over bytes and byte pairs."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.scales, self.parts = [], []
        for width, kernel in zip(WIDTHS, net.filters, strict=True):
            by_place = [net.embedding @ k for k in kernel.reshape(width, EMBEDDING, FILTERS)]
            reach = sum(np.abs(t).max() for t in by_place)
            scale = 32_000 / max(reach, 1e-6)
            parts = []
            for j in range(0, width - 1, 2):
                pair = (by_place[j][:, None, :] + by_place[j + 1][None, :, :]).reshape(65_536, FILTERS)
                parts.append((j, True, np.round(pair * scale).astype(np.int16)))
            if width % 2:
                parts.append((width - 1, False, np.round(by_place[-1] * scale).astype(np.int16)))
            self.scales.append(scale)
            self.parts.append(parts)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(windows), CHUNK):
            x = windows[i : i + CHUNK].astype(np.int32)
            pairs = (x[:, :-1] << 8) | x[:, 1:]
            pooled = []
            for width, scale, parts in zip(WIDTHS, self.scales, self.parts, strict=True):
                places = WINDOW - width + 1
                total = None
                for j, pair, values in parts:
                    found = np.take(values, (pairs if pair else x)[:, j : j + places], axis=0)
                    total = found if total is None else np.add(total, found, out=total)
                while places > 1:
                    half = (places + 1) // 2
                    total = np.maximum(total[:, :half], total[:, places - half : places])
                    places = half
                pooled.append(total[:, 0].astype(np.float32) / scale)
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.net.bias, 0)
            scores = hidden @ self.net.weights + self.net.offset
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            out.append(scores / scores.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.net.languages)), np.float32)


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts, the last one of a text filled up with blanks, and each text's bounds."""
    sizes = np.diff(bounds)
    ends = np.concatenate([[0], np.cumsum(-(-sizes // WINDOW))])
    out = np.full(ends[-1] * WINDOW, 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(ends[:-1] * WINDOW - bounds[:-1], sizes)] = FOLD[data]
    return out.reshape(-1, WINDOW), ends


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows spread evenly over each text."""
    schema = pa.schema([("lang", pa.string()), ("window", pa.binary())])
    for batch in batches:
        langs, out = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            windows, _ = cut(data, np.array([0, len(data)]))
            for i in np.unique(np.linspace(0, len(windows) - 1, TEXT_WINDOWS).round().astype(int)):
                langs.append(lang)
                out.append(windows[i].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], schema=schema)


def fit(labelled: DataFrame) -> Network | None:
    """Network from rows (doc_id, text, lang); None without any. Equal shares of SAMPLE_WINDOWS for the languages."""
    rows = labelled.filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = sorted(
        (r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    )
    if not counts:
        return None
    share = SAMPLE_WINDOWS / len(counts) / TEXT_WINDOWS
    parts = [F.when(F.col("lang") == lang, F.lit(min(1.0, share / n))) for lang, n in counts]
    # A second number beside the id keeps rows with one repeated id apart.
    draw = F.pmod(F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)
    picked = rows.select("doc_id", "text", "lang").withColumn("draw", draw).filter(F.col("draw") < F.coalesce(*parts))
    sample = picked.select("lang", "text").mapInArrow(_sample, "lang string, window binary").limit(2 * SAMPLE_WINDOWS).toArrow()
    languages = sorted(set(sample.column("lang").to_pylist()))
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[x] for x in sample.column("lang").to_pylist()])
    windows = np.stack([np.frombuffer(w, np.uint8) for w in sample.column("window").to_pylist()])
    order = np.lexsort((*windows.T[::32], labels))
    return train(windows[order], labels[order], languages)


def _predict(net: Network, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tables = Tables(net)
        for batch in batches:
            mean = np.zeros((len(batch), len(net.languages)))
            for group in hashing.groups(batch.column("text")):
                windows, ends = cut(group.data, group.bounds)
                found = tables.probabilities(windows)
                sums = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0, dtype=np.float64)])
                count = np.maximum(np.diff(ends), 1)[:, None]
                mean[group.first : group.first + len(count)] = (sums[ends[1:]] - sums[ends[:-1]]) / count
            best = mean.argmax(axis=1)
            letters = batch.column("has_letter").to_pylist()
            names = [net.languages[b] if has else NO_LANGUAGE for b, has in zip(best, letters, strict=True)]
            score = np.where(letters, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0) if len(best) else np.zeros(0)
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (mean probability over all windows of the text).

    A null text, or one without a letter, is ``und`` with score 0; so is every text where nothing
    could be learned. Repeated rows get equal answers; an empty table stays empty. Columns of these
    names in ``docs`` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "has_letter")]
    base = docs.select(*keep).withColumn("has_letter", has_letter(F.col("text")))
    if net is None:
        return base.drop("has_letter").withColumn("lang_pred", F.lit(NO_LANGUAGE)).withColumn("score", F.lit(0.0))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "has_letter")
    return base.mapInArrow(_predict(net, keep), f"{fields}, lang_pred string, score double")


def filled(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", whole_text(F.col("text")))
