"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows lie in blocks. A matrix with one line per block says how many of its rows go to each
shard; it is drawn from the multivariate hypergeometric law, so the result is distributed as if
one machine had shuffled all rows and cut the list into shards. Each block permutes its rows and
deals them out by its line, the rows are exchanged, and each shard permutes what it received.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.tables import stored, whole_text

#: Rows of a block, and of the part of a shard that one task permutes.
BLOCK_ROWS = 65_536
#: Blocks of a small table, so that it still spreads over the tasks.
LEAST_BLOCKS = 64


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken without replacement are among the ``good`` ones.

    Inverse of the distribution function on the values within 12 standard deviations of the mode;
    the mass outside is below the precision of a double. It has no limit on the population.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    deviation = (draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1))) ** 0.5
    reach = int(12 * deviation) + 12
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weights = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(weights - weights.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(sizes: list[int], capacities: list[int], seed: int) -> np.ndarray:
    """Rows of block i that go to shard j; line sums are ``sizes``, column sums ``capacities``."""
    if sum(sizes) != sum(capacities):
        raise ValueError("blocks and shards must hold the same number of rows")
    rng = np.random.default_rng(seed)
    left = [int(c) for c in capacities]
    matrix = np.zeros((len(sizes), len(left)), dtype=np.int64)
    for i, size in enumerate(sizes):
        rest, draws = sum(left), int(size)
        for j, room in enumerate(left):
            rest -= room
            taken = hypergeometric(rng, room, rest, draws)
            matrix[i, j] = taken
            left[j] -= taken
            draws -= taken
    return matrix


def shuffle_into_shards(
    rows: DataFrame, shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 inside a shard).

    Shard sizes differ by one row at most and every assignment is equally likely. Repeated rows,
    null values and equal keys need no care: rows are told apart by a number that is given once
    and stored. An empty table stays empty. The rows pass three narrow exchanges, so hand over
    identifiers and sizes rather than texts. The matrix has a line for every ``block_rows`` rows.
    """
    spark = rows.sparkSession
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    total = numbered.count()
    blocks = max(LEAST_BLOCKS, -(-total // block_rows))
    placed = numbered.withColumn("_block", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)))
    counted = sorted((r["_block"], r["n"]) for r in placed.groupBy("_block").agg(F.count("*").alias("n")).collect())
    capacities = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([n for _, n in counted], capacities, seed)
    ends = spark.createDataFrame(
        [(b, line) for (b, _), line in zip(counted, np.cumsum(matrix, axis=1).tolist(), strict=True)],
        "_block long, _ends array<long>",
    )
    local = Window.partitionBy("_block").orderBy(F.xxhash64("_row", F.lit(seed + 1)), "_row")
    dealt = (
        placed.join(ends, "_block")
        .withColumn("_place", F.row_number().over(local) - 1)
        .withColumn("shard", F.expr("cast(size(filter(_ends, e -> e <= _place)) as int)"))
        .drop("_block", "_ends", "_place")
    )
    parts = max(LEAST_BLOCKS // 4, -(-total // (shards * block_rows)))
    dealt = dealt.withColumn("_key", F.xxhash64("_row", F.lit(seed + 2))).withColumn(
        "_part", F.shiftright(F.shiftrightunsigned("_key", 33) * F.lit(parts), 31)
    )
    dealt = stored(dealt)
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "_part")
        .agg(F.count("*").alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    again = Window.partitionBy("shard", "_part").orderBy("_key", "_row")
    return (
        dealt.join(offsets, ["shard", "_part"])
        .withColumn("slot", F.col("_before") + F.row_number().over(again) - 1)
        .drop("_row", "_part", "_key", "_before")
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 17) -> DataFrame:
    """Every document with its shard, by row counts.

    A null text counts as an empty one: size 8 and the crc32 of nothing. A null id stays null.
    """
    text = whole_text(F.col("text")).cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shuffle_into_shards(narrow, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
