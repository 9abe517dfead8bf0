import math
import random

import numpy as np
from pyspark.sql import functions as F

from dwellspark.llm import topk


def brute(vectors, queries, k):
    out = []
    for q, x in queries.items():
        scored = sorted(((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in vectors if i != q and len(y) == len(x)))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_against_brute_force_with_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 50)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)] + [(2000, [0.0] * 12), (2020, [0.0] * 12)]
    bad = [(3000, None), (3020, [None] + [0.1] * 11), (3040, [math.nan] * 12), (3060, [math.inf] * 12), (3080, []), (None, [0.1] * 12)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    vectors = topk.integer_vectors(frame, "vec_id", "embedding", 64)
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    queries = {i: v for i, v in whole if i % 20 == 0}
    got = sorted(map(tuple, topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 5).collect()))
    assert got == brute(whole, queries, 5)


def test_large_numbers_and_few_candidates(spark):
    vectors = spark.createDataFrame([(0, [2**40, -(2**40)]), (1, [2**20, 3]), (2, [-1, 2**20])], "vec_id long, v array<long>")
    got = sorted(map(tuple, topk.top_k(vectors, vectors.filter("vec_id = 0"), 5).collect()))
    assert got == [(0, 1, 1, 2**60 - 3 * 2**40), (0, 2, 2, -(2**40) - 2**60)]
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_bounds_prove_before_all_segments_are_read():
    rng = np.random.default_rng(3)
    values = rng.integers(-2, 3, (4000, 16))
    values[:30] = 60
    q, v, s = topk.best_in_block(np.array([-1]), np.full((1, 16), 9), np.arange(4000), values, 5)
    assert v.tolist() == [0, 1, 2, 3, 4] and s.tolist() == [60 * 9 * 16] * 5
