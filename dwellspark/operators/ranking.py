"""Positions in a global order without one task that orders everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.session import materialise


def numbered(df: DataFrame, order: list[Column], name: str, within: str | None = None) -> DataFrame:
    """``df`` with its place, from 1, in ``order``; with ``within``, the place in the rows of its value.

    Rows are range-partitioned and sorted by Spark, each partition counts its own rows, and the counts
    of the partitions before it are added: as many numbers as there are partitions and values of
    ``within``, of which there are to be few.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    group = F.lit("").alias("_within") if within is None else F.col(within).alias("_within")
    ordered = df.select("*", group).orderBy("_within", *order)
    kept = materialise(ordered.withColumn("_part", F.spark_partition_id()).withColumn("_inside", inside))
    counts = kept.groupBy("_within", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_inside").alias("first"))
    before, offsets, last = 0, [], None
    for r in sorted(counts.collect(), key=lambda r: (r["_within"], r["_part"])):
        before = before if r["_within"] == last else 0
        offsets.append((r["_within"], r["_part"], before - r["first"]))
        before, last = before + r["n"], r["_within"]
    known = df.sparkSession.createDataFrame(offsets, "_within string, _part int, _shift long")
    place = (F.col("_shift") + F.col("_inside") + 1).cast("int")
    return kept.join(known, ["_within", "_part"]).withColumn(name, place).drop("_within", "_part", "_inside", "_shift")


def first_numbered(df: DataFrame, order: list[Column], limit: int, name: str) -> DataFrame:
    """The first ``limit`` rows with their place: a top-n in every task, then one of what is left."""
    top = df.orderBy(*order).limit(limit)
    return numbered(top, order, name)
