"""Hashes of words, shingles and byte windows over the buffers of an Arrow text column.

A batch is worked on in groups of whole texts, so temporary arrays stay small. Word and window
hashes are differences of one prefix sum of byte codes times powers of an odd number, modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of texts that are worked on together; a longer text is a group of its own. A worker keeps what
#: its largest group once took, about a hundred times these bytes.
GROUP_BYTES = 1 << 17

_RNG = np.random.default_rng(20_240_229)
CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
MULTIPLIERS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_POWERS = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, count: int) -> np.ndarray:
    held = _POWERS[base]
    if len(held) < count:
        held = np.full(max(count, GROUP_BYTES + 1), np.uint64(base))
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        _POWERS[base] = held
    return held[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Group:
    """Texts ``first`` to ``first + len(bounds) - 2`` of a batch; text i is data[bounds[i]:bounds[i+1]]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def groups(column: pa.Array) -> Iterator[Group]:
    if not len(column):
        return
    data, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        start, end = int(offsets[first]), int(offsets[last])
        yield Group(first, data[start:end], offsets[first : last + 1] - start)
        first = last


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * powers(BASE, len(data)), out=out[1:])
    return out


@dataclass
class Words:
    """Hash of every word, where it starts, and where each text's words begin and end."""

    hashes: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray


def words(group: Group, separator: np.ndarray, fold: np.ndarray) -> Words:
    """Words are runs of bytes that are no separator, after ``fold``; none spans two texts."""
    data = fold[group.data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    # A text boundary inside a run cuts it.
    cuts = group.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    both = cuts[inside[cuts] & inside[cuts + 1]]
    begins[both] = True
    stops[both - 1] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sums = prefix_sums(data)
    hashes = mix((sums[ends] - sums[starts]) * powers(INVERSE, len(data) + 1)[starts])
    return Words(hashes, starts, np.searchsorted(starts, group.bounds))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the bounds of each text's runs.

    A text with fewer words has its whole sequence as one run; a text without words has none.
    """
    h, bounds = found.hashes, found.bounds
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for j in range(size):
        total += h[j : j + len(total)] * MULTIPLIERS[j]
    ends = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(bounds[:-1] - ends[:-1], runs) + np.arange(ends[-1])
    out = np.zeros(len(at), np.uint64)
    full = np.repeat(counts >= size, runs)
    out[full] = total[at[full]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        part = h[bounds[i] : bounds[i + 1]]
        out[ends[i]] = np.append(part * MULTIPLIERS[: len(part)], MULTIPLIERS[32 + len(part)]).sum(dtype=np.uint64)
    return mix(out), ends


def fold_table(upper: bool = True) -> np.ndarray:
    """Bytes with A to Z in lower case."""
    out = np.arange(256, dtype=np.uint8)
    if upper:
        out[65:91] += 32
    return out


def byte_set(*parts: int | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for part in parts:
        out[list(part) if isinstance(part, range) else part] = True
    return out
