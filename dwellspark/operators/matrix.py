"""Duration matrices: leads per group, product (and status) and whole day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.functions.text import strip, whole_days
from dwellspark.operators.histogram import percentile_label, percentile_stats
from dwellspark.operators.norms import attach
from dwellspark.operators.ranking import numbered
from dwellspark.session import materialise


def row_keys(include_status: bool) -> list[str]:
    return ["product_group", "product", *(["current_status"] if include_status else [])]


def matrix_counts(
    snapshot: DataFrame,
    include_status: bool = False,
    max_days: int | None = None,
    days: str = "days_on_stage",
) -> DataFrame:
    """Leads per row and day. With `max_days` only so many of the most populated days stay.

    Rows with neither group nor product, and rows without days, are left out.
    """
    keys = row_keys(include_status)
    work = snapshot.select(
        *[F.coalesce(strip(F.col(k)), F.lit("")).alias(k) for k in keys], whole_days(F.col(days)).alias("day")
    )
    work = work.filter(
        F.col("day").isNotNull() & ((F.col("product_group") != "") | (F.col("product") != ""))
    )
    if include_status:
        work = work.filter(F.col("current_status") != "")
    counts = work.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("cnt"))
    if max_days is None:
        return counts
    popular = counts.groupBy("day").agg(F.sum("cnt").alias("leads"))
    popular = popular.orderBy(F.desc("leads"), "day").limit(max_days)
    return counts.join(popular.select("day"), "day", "left_semi").select(*counts.columns)


def matrix_totals(counts: DataFrame) -> DataFrame:
    """Leads per day; the row without a day is the grand total."""
    return counts.groupingSets([["day"], []], "day").agg(F.sum("cnt").alias("leads"))


def matrix_percentiles(
    counts: DataFrame, include_status: bool = False, percentiles: Sequence[float] = (20, 50, 80)
) -> DataFrame:
    """Total and empirical percentiles of every row."""
    keys = row_keys(include_status)
    stats = percentile_stats(counts, keys, percentiles, "d")
    return stats.select(
        *keys,
        F.col("d_count").alias("total"),
        *[F.col(f"d_{percentile_label(p)}_days").alias(percentile_label(p)) for p in percentiles],
    )


def duration_matrix(
    counts: DataFrame,
    include_status: bool = False,
    layout: str = "by_volume",
    cut: Callable[[DataFrame], DataFrame] = materialise,
) -> DataFrame:
    """Cells with the positions of their row and day in a layout.

    Layouts: by_volume (rows and days by leads), alpha_days (names, then days),
    group_alpha_product_volume (group by name, product by leads inside it). The counts are used for
    rows, days and cells, so they are written once by `cut`; rows and days get their places in one sort.
    """
    counts = cut(counts)
    keys = row_keys(include_status)
    names = [F.lower(k) for k in keys] + [F.col(k) for k in keys]
    rows = counts.groupBy(*keys).agg(F.sum("cnt").alias("total"))
    volume = F.lit(None).cast("long")
    if layout == "group_alpha_product_volume":
        volume = F.sum("total").over(Window.partitionBy("product_group", "product"))
        order = [F.lower("product_group"), F.desc("_volume"), *names[1:], F.col("day")]
    elif layout == "by_volume":
        order = [F.desc("total"), *names, F.col("day")]
    else:
        order = [*names, F.col("day")]
    rows = rows.withColumn("_volume", volume).select(F.lit("row").alias("_kind"), "*")
    days = counts.groupBy("day").agg(F.sum("cnt").alias("total")).select(F.lit("day").alias("_kind"), "*")
    placed = numbered(rows.unionByName(days, allowMissingColumns=True), order, "position", within="_kind")
    of_row = placed.filter(F.col("_kind") == "row").select(
        *keys, F.col("total").alias("row_total"), F.col("position").alias("row_position")
    )
    of_day = placed.filter(F.col("_kind") == "day").select(
        "day", F.col("total").alias("day_total"), F.col("position").alias("day_position")
    )
    return attach(counts, of_row, keys, "inner").join(of_day, "day").select(
        *keys, "day", "cnt", "row_total", "day_total", "row_position", "day_position"
    )


def wide_rows(counts: DataFrame, include_status: bool = False) -> DataFrame:
    """One row per group with the counts as a map from day to leads, for a sink."""
    keys = row_keys(include_status)
    pairs = F.array_sort(F.collect_list(F.struct("day", "cnt")))
    return counts.groupBy(*keys).agg(F.map_from_entries(pairs).alias("leads_by_day"), F.sum("cnt").alias("total"))
