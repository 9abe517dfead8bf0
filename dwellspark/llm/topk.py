"""Exact top-k by inner product on a score-at-a-time index in order of impact.

Vectors lie in blocks. A block keeps its postings (vector, component, value) in segments of falling
quantised impact, the magnitude of the value. Queries read the segments one after the other and add
up scores. After each segment a vector can gain at most the product of the query's norm and the norm
of what it has in the segments still unread. A vector that cannot reach the k-th best lower bound any
more is proven out. Reading goes on until the segments are used up or few possible members
are left; those are rescored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of an index block, and queries that are answered together.
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 1024
#: Segments hold the postings with at least this share of the largest magnitude of the block.
SHARES = (0.35, 0.18, 0.08, 0.0)
#: Possible members per query that end the reading: rescoring them costs less than a segment.
FEW = 0.02


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component as long.

    Null vectors and vectors with a null or non-finite component take no part, nor do empty ones.
    """
    wide = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    good = wide.filter(
        F.col("vec_id").isNotNull()
        & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    )
    return good.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _packed(ids: np.ndarray, matrix: np.ndarray) -> tuple[bytes, bytes, int]:
    return ids.astype("<i8").tobytes(), matrix.astype("<i8").tobytes(), matrix.shape[1]


def _pack(size: int):
    """Rows (block, vec_id, v) sorted by block become one packed row per block and dimension."""
    schema = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            offsets = batch.column("v").offsets.to_numpy()
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
            groups: dict[tuple[int, int], list[int]] = {}
            for i, key in enumerate(zip(blocks.tolist(), lengths.tolist(), strict=True)):
                groups.setdefault(key, []).append(i)
            for key, rows in groups.items():
                at = starts[rows][:, None] + np.arange(key[1])[None, :]
                held.setdefault(key, []).append((ids[rows], values[at]))
            for key in [k for k, parts in held.items() if sum(len(p[0]) for p in parts) >= size]:
                yield _one(key, held.pop(key), schema)
        for key, parts in held.items():
            yield _one(key, parts, schema)

    return run


def _one(key, parts, schema) -> pa.RecordBatch:
    ids, data, dims = _packed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int64()), pa.array([dims], pa.int32()), pa.array([ids], pa.binary()), pa.array([data], pa.binary())],
        schema=schema,
    )


def _segments(values: np.ndarray) -> list[np.ndarray]:
    """Postings by falling impact, each segment as a matrix that holds its postings only."""
    size = np.abs(values)
    limits = [max(1, int(np.ceil(size.max(initial=0) * s))) for s in SHARES]
    out, above = [], None
    for limit in limits:
        inside = size >= limit if above is None else (size >= limit) & (size < above)
        out.append(np.where(inside, values, 0.0))
        above = limit
    return out


def best_in_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of each query's ``k`` best vectors of a block, ties to smaller ids.

    Sums stay exact in doubles below 2**53; beyond that Python's integers are used.
    """
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(values).max(initial=0)) * max(values.shape[1], 1)
    if largest >= 2**52:
        exact = queries.astype(object) @ values.astype(object).T
        return _take(query_ids, ids, [(np.arange(len(ids)), row) for row in exact], k)
    q, v = queries.astype(np.float64), values.astype(np.float64)
    segments = _segments(v)
    unread = np.zeros((len(segments) + 1, len(ids)))
    for i in range(len(segments) - 1, -1, -1):
        unread[i] = unread[i + 1] + np.einsum("ij,ij->i", segments[i], segments[i])
    norms = np.sqrt(np.einsum("ij,ij->i", q, q))
    own = query_ids[:, None] == ids[None, :]
    scores = np.zeros((len(q), len(ids)))
    members = [None] * len(q)
    open_rows = np.arange(len(q))
    few = max(4 * k, int(FEW * len(ids)))
    for i, segment in enumerate(segments):
        scores[open_rows] += q[open_rows] @ segment.T
        if len(ids) <= few or i == len(segments) - 1:
            continue
        gain = norms[open_rows][:, None] * np.sqrt(unread[i + 1])[None, :] * (1 + 1e-9) + 1e-6
        low = np.where(own[open_rows], -np.inf, scores[open_rows] - gain)
        bar = -np.partition(-low, k - 1, axis=1)[:, k - 1]
        possible = (scores[open_rows] + gain >= bar[:, None]) & ~own[open_rows]
        small = possible.sum(axis=1) <= few
        for at in np.flatnonzero(small):
            found = np.flatnonzero(possible[at])
            members[open_rows[at]] = (found, v[found] @ q[open_rows[at]])
        open_rows = open_rows[~small]
    for row in open_rows:
        line = scores[row]
        line[own[row]] = -np.inf
        if len(ids) > k:
            bar = np.partition(line, len(ids) - k)[len(ids) - k]
            found = np.flatnonzero(line >= bar)
        else:
            found = np.arange(len(ids))
        members[row] = (found, line[found])
    return _take(query_ids, ids, members, k)


def _take(query_ids, ids, members, k):
    out_q, out_v, out_s = [], [], []
    for row, (found, score) in enumerate(members):
        keep = ids[found] != query_ids[row]
        found, score = found[keep], score[keep]
        if score.dtype == object:
            order = np.array(sorted(range(len(found)), key=lambda i: (-score[i], ids[found[i]]))[:k], dtype=int)
        else:
            order = np.lexsort((ids[found], -score))[:k]
        out_q.append(np.full(len(order), query_ids[row]))
        out_v.append(ids[found][order])
        out_s.append(np.array([int(s) for s in score[order]], dtype=np.int64))
    if not out_q:
        empty = np.array([], dtype=np.int64)
        return empty, empty, empty
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = best_in_block(
                    np.frombuffer(row["q_ids"], "<i8"),
                    np.frombuffer(row["q_data"], "<i8").reshape(-1, row["dims"]),
                    np.frombuffer(row["ids"], "<i8"),
                    np.frombuffer(row["data"], "<i8").reshape(-1, row["dims"]),
                    k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    return run


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Packed blocks of about ``size`` rows; ids spread over the blocks by their hash."""
    count = rows.count()
    number = max(1, -(-count // size))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(number)))
    packed = placed.repartition(number, "block").mapInArrow(
        _pack(size), "block long, dims int, ids binary, data binary"
    )
    return packed, number


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best vectors other than itself.

    Both frames have ``vec_id`` and ``v`` (array of long). Ties go to the smaller id; a query with
    fewer candidates gets all of them; candidates have the query's number of dimensions; repeated
    rows of an id are candidates of their own, and as queries they count once (the smallest vector);
    empty inputs give no row. Every block of queries meets every block of the index once, as two
    packed rows joined on the pair of block numbers.
    """
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    index, n_index = _blocks(vectors, BLOCK_VECTORS)
    asked, n_asked = _blocks(queries, BLOCK_QUERIES)
    left = index.select(
        F.col("block").alias("v_block"), "dims", "ids", "data", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("q_block")
    )
    right = asked.select(
        F.col("block").alias("q_block"),
        "dims",
        F.col("ids").alias("q_ids"),
        F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0), F.lit(n_index - 1))).alias("v_block"),
    )
    pairs = left.join(right, ["v_block", "q_block", "dims"])
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
