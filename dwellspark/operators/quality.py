"""Checks that nothing is lost on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.text import strip


def _leads(df: DataFrame, lead: str, side: int) -> DataFrame:
    return df.select(strip(F.col(lead)).alias("lead_id"), F.lit(side).alias("side")).filter(F.col("lead_id") != "")


def lead_coverage(before: DataFrame, after: DataFrame, lead: str = "lead_id") -> DataFrame:
    """Leads on one side only: missing from the result, or extra in it.

    Both sides are tagged and meet in one aggregation, which forgets repetitions before its exchange.
    """
    tagged = _leads(before, lead, 1).unionByName(_leads(after, lead, 2))
    sides = tagged.groupBy("lead_id").agg(F.bit_or("side").alias("sides"))
    only = sides.filter(F.col("sides") != 3)
    return only.select("lead_id", F.when(F.col("sides") == 1, "missing").otherwise("extra").alias("side"))


def missing_days(records: DataFrame) -> DataFrame:
    """Records, and those of them without days; they stay in the analysis."""
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("days_on_stage").isNull()).alias("without_days"),
    )


def row_audit(before: DataFrame, after: DataFrame, reason: str) -> DataFrame:
    """Row counts on both sides of a step, with the reason for the difference."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"))
    n = after.agg(F.count(F.lit(1)).alias("rows_after")).scalar()
    return a.select("rows_before", n.alias("rows_after")).select(
        "*", (F.col("rows_before") - F.col("rows_after")).alias("dropped"), F.lit(reason).alias("reason")
    )


class RowCounts:
    """Rows at the steps of a run, counted by the job that runs anyway.

    `watch` marks a step and gives the frame to go on with; `table` says after the run how many rows
    each step had and lost. Rows are counted where they are, so a filter does not move across a marked
    step. Tasks that are run again are counted once as long as the steps belong to the stage that
    writes, as they do for filters before a write; rows behind a shuffle whose files were lost would be
    counted again, and `row_audit` is exact there.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, str | None, Observation]] = []

    def watch(self, df: DataFrame, step: str, reason: str | None = None) -> DataFrame:
        """`reason` says why rows may be fewer than at the step before."""
        seen = Observation()
        self._steps.append((step, reason, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """`step_no, step, rows_before, rows_after, dropped, reason, unexplained` in the order of the steps.

        Waits for the job. The first step has nothing before it; rows that are lost without a reason are
        unexplained.
        """
        out, before = [], None
        for number, (step, reason, seen) in enumerate(self._steps):
            now = seen.get["rows"]
            before = now if before is None else before
            out.append((number, step, before, now, before - now, reason, before > now and reason is None))
            before = now
        return spark.createDataFrame(
            out,
            "step_no int, step string, rows_before long, rows_after long, dropped long, reason string, unexplained boolean",
        )
