import zlib

import numpy as np

from dwellspark.llm import sharding


def test_hypergeometric_has_the_right_mean_and_support():
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert min(draws) >= 0 and max(draws) <= 20 and abs(np.mean(draws) - 6) < 0.15
    assert abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0
    assert abs(sharding.hypergeometric(rng, 10**11, 3 * 10**11, 10**9) / 10**9 - 0.25) < 1e-3


def test_matrix_keeps_both_sums():
    matrix = sharding.communication_matrix([5, 0, 9, 14], [7, 7, 7, 7], 3)
    assert matrix.sum(axis=1).tolist() == [5, 0, 9, 14] and matrix.sum(axis=0).tolist() == [7] * 4


def test_exact_shards_gapless_slots_and_repeated_rows(documents):
    rows = [(i, f"text {i} é") for i in range(190)] + [(7, "same")] * 100 + [(None, None), (500, "")]
    got = sharding.shard_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes = np.bincount([r["shard"] for r in got], minlength=24)
    assert sizes.max() - sizes.min() <= 1
    for shard in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sizes[shard]))
    empty = [r for r in got if r["doc_id"] is None][0]
    assert (empty["size"], empty["text_crc32"], empty["law"], empty["grown_shard"]) == (8, 0, "rows", None)
    one = [r for r in got if r["doc_id"] == 3][0]
    assert (one["size"], one["text_crc32"]) == (len("text 3 é".encode()) + 8, zlib.crc32("text 3 é".encode()))


def test_same_seed_same_result_other_seed_other_result(documents):
    docs = documents([(i, "t") for i in range(60)])
    a, b, c = ({r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(docs, 5, s).collect()} for s in (1, 1, 2))
    assert a == b and a != c


def test_empty_table(documents):
    assert sharding.shard_documents(documents([])).count() == 0
