"""Exact distinct counts on many levels from one pass, by bitmaps.

Distinct values get dense numbers once. The numbers of a group are bits of fixed blocks (of 32,768 bits
each), which are put together with "or" without looking at a row again: from territory to overall, from
product to group, from mask to slice. A group of any size is as many blocks as its numbers fall into,
and blocks are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.operators.norms import attach
from dwellspark.operators.ranking import numbered
from dwellspark.session import materialise

BLOCK, BITS = "_block", "_bits"


def dense_numbers(df: DataFrame, column: str) -> DataFrame:
    """``column, number``: every value that is not null, numbered from 1 in its order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return numbered(values, [F.col(column)], "number")


def member_bitmaps(df: DataFrame, keys: Sequence[str], column: str, numbers: DataFrame | None = None) -> DataFrame:
    """``keys``, block and bits of the values of ``column`` in each group.

    Several frames that are to be compared or put together need the same ``numbers``. Repetitions inside
    a group are forgotten before the numbers are looked up.
    """
    own = numbers if numbers is not None else dense_numbers(df, column)
    pairs = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    known = pairs.join(own, column).select(*keys, F.col("number").cast("long").alias("number"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number"))
    return known.groupBy(*keys, F.bitmap_bucket_number("number").alias(BLOCK)).agg(bits.alias(BITS))


def rolled_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps on fewer keys."""
    return bitmaps.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def members(bitmaps: DataFrame, keys: Sequence[str], name: str = "members") -> DataFrame:
    """Distinct values per group."""
    return bitmaps.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("long").alias(name))


def distinct_levels(
    df: DataFrame, levels: Sequence[Sequence[str]], columns: Sequence[str], numbers: dict[str, DataFrame] | None = None
) -> list[DataFrame]:
    """For every level (a list of keys) its groups with ``n_<column>``, the distinct values of each column.

    What stands behind the rows is read once: keys and columns are written, and groups, numbers and the
    bitmaps of the level of all keys are made from that. Every other level is put together from the
    smallest level before it that has its keys. A group without a value has 0; a level without
    keys is one row.
    """
    order = sorted(range(len(levels)), key=lambda i: -len(set(levels[i])))
    finest = list(dict.fromkeys(k for level in levels for k in level))
    df = materialise(df.select(*dict.fromkeys([*finest, *columns])))
    groups = materialise(df.select(*finest).distinct()) if finest else df.select(F.lit(1).alias("_")).limit(1)
    out: dict[int, DataFrame] = {
        i: (groups.select(*levels[i]).distinct() if levels[i] else df.sparkSession.range(1).select()) for i in order
    }
    for column in columns:
        held = [(finest, materialise(member_bitmaps(df, finest, column, (numbers or {}).get(column))))]
        for i in order:
            keys = list(levels[i])
            _, nearest = min((h for h in held if set(keys) <= set(h[0])), key=lambda h: len(h[0]))
            own = nearest if set(keys) == set(held[0][0]) else materialise(rolled_up(nearest, keys))
            held.append((keys, own))
            counts = members(own, keys, f"n_{column}")
            if keys:
                counted = attach(out[i], counts, keys)
            else:
                counted = counts if not out[i].columns else out[i].select("*", counts.scalar().alias(f"n_{column}"))
            out[i] = counted.withColumn(f"n_{column}", F.coalesce(f"n_{column}", F.lit(0)).cast("long"))
    return [out[i] for i in range(len(levels))]


def distinct_rollup(df: DataFrame, levels: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """All levels in one table: `level` (its number), the keys (null where a level does not have them), counts."""
    found = distinct_levels(df, levels, columns)
    keys = list(dict.fromkeys(k for level in levels for k in level))
    parts = [
        part.select(
            F.lit(i).alias("level"),
            *[F.col(k) if k in levels[i] else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys],
            *[f"n_{c}" for c in columns],
        )
        for i, part in enumerate(found)
    ]
    return reduce(DataFrame.unionByName, parts)
