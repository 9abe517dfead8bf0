"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.tables import stored

#: Rounds after which something must be wrong: each halves the longest path.
MOST_ROUNDS = 60
#: Links of a task. Rounds over a small table would else leave a file for every pair of tasks.
TASK_LINKS = 200_000


def _star(links: DataFrame, both_ways: bool, tasks: int) -> DataFrame:
    """Links neighbours of a node to the smallest of them; hot nodes are reduced before the shuffle."""
    if both_ways:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = ends.join(least, "a").coalesce(tasks)
    if both_ways:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")).coalesce(tasks)
        )
    return out.filter(F.col("a") != F.col("b")).coalesce(tasks).distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every linked node; the component is its smallest node.

    ``links`` has columns a and b in any order, with repetitions. Star contraction in alternating
    rounds, each written to the shared folder; nothing but two sums comes to the driver.
    """
    now = stored(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    tasks = -(-now.count() // TASK_LINKS) or 1
    mark = None
    for _ in range(MOST_ROUNDS):
        now = stored(_star(_star(now.coalesce(tasks), True, tasks), False, tasks))
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            break
        mark = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
