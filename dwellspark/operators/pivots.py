"""Pivot tables and dimension lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import is_empty, strip
from dwellspark.operators.histogram import percentile_label

PIVOT_KEYS = ("tb", "row_key", "metric", "indicator")


def indicators(percentiles: Sequence[float] = (20, 50, 80)) -> list[str]:
    return ["min", "max", *[percentile_label(p) for p in percentiles]]


def pivot_flat(
    table: DataFrame,
    metrics: Sequence[str] = ("days_on_stage",),
    percentiles: Sequence[float] = (20, 50, 80),
    group_only: bool = False,
    all_label: str = K.ALL_SERIES,
    stage: str = "stage_key",
    tags: Sequence[str] = (),
) -> DataFrame:
    """Norms in long form: one row per territory, group, stage, metric and indicator."""
    cells = []
    for m in metrics:
        for i in indicators(percentiles):
            value = f"{m}_{i}" if i in ("min", "max") else f"{m}_{i}_days"
            cells.append(
                F.struct(
                    F.lit(m).alias("metric"),
                    F.lit(i).alias("indicator"),
                    F.col(value).cast("long").alias("value"),
                    F.col(f"{m}_{i}_le_count").cast("long").alias("leads_le"),
                    F.col(f"{m}_{i}_gt_count").cast("long").alias("leads_gt"),
                )
            )
    product = F.lit(K.GROUP_ONLY_PRODUCT) if group_only else F.col("product")
    level = [F.col("analysis_level")] if "analysis_level" in table.columns else []
    rows = table.filter(F.col("is_all") | F.col("tb").isNotNull()).select(
        *tags,
        F.when(F.col("is_all"), F.lit(all_label)).otherwise(F.col("tb")).alias("tb"),
        "product_group",
        product.alias("product"),
        (F.col("product_group") if group_only else product).alias("row_key"),
        F.col(stage).alias("stage_key"),
        *level,
        F.inline(F.array(*cells)),
    )
    return rows.filter(F.col("value").isNotNull())


def stage_order(
    df: DataFrame, configured: Sequence[str], excluded: Sequence[str] = (), stage: str = "stage_key"
) -> DataFrame:
    """Stages with their position: configured ones first, then the others by name."""
    out = {s.lower() for s in excluded}
    kept = [s for s in configured if s.lower() not in out]
    known = df.sparkSession.createDataFrame(
        [(s, i) for i, s in enumerate(kept, start=1)], f"{stage} string, position int"
    )
    seen = df.select(stage).filter(F.col(stage).isNotNull()).distinct()
    if out:
        seen = seen.filter(~F.lower(stage).isin(list(out)))
    others = seen.join(known, stage, "left_anti")
    # Stages are few: a list of their names, not of rows.
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.lower(stage), stage))
    return known.unionByName(others.select(stage, (place + len(kept)).cast("int").alias("position")))


def ordered_stages(present: Sequence[str], configured: Sequence[str], excluded: Sequence[str] = ()) -> list[str]:
    out = {s.lower() for s in excluded}
    names = [*configured, *[p for p in present if p not in configured]]
    return [s for s in dict.fromkeys(names) if s.lower() not in out]


def pivot_matrix(
    flat: DataFrame,
    stages: Sequence[str],
    keys: Sequence[str] = PIVOT_KEYS,
    tbs: Sequence[str] | None = None,
    metric: str | None = None,
    indicator: str | None = None,
) -> DataFrame:
    """Row x stage matrix; the cell with the most days wins where several fall together."""
    for name, value in (("metric", metric), ("indicator", indicator)):
        if value is not None:
            flat = flat.filter(F.col(name) == value)
    if tbs is not None:
        flat = flat.filter(F.col("tb").isin(list(tbs)))
    return flat.groupBy(*keys).pivot("stage_key", list(stages)).agg(F.max("value"))


def pivot_cells(flat: DataFrame, keys: Sequence[str] = ("row_key", "metric", "indicator")) -> DataFrame:
    """Cells of a matrix over several territories, with the lead counts of the winning one."""
    cell = F.struct("value", "leads_le", "leads_gt")
    best = flat.groupBy(*keys, "stage_key").agg(F.max_by(cell, F.struct("value", "leads_le", "tb", "leads_gt")).alias("cell"))
    return best.select(*keys, "stage_key", "cell.*")


def sort_rows(matrix: DataFrame, stage: str, row: str = "row_key", ascending: bool = True) -> DataFrame:
    """Rows by one stage; rows without a value last, among themselves by name."""
    c = F.col(f"`{stage}`")
    return matrix.orderBy(c.asc_nulls_last() if ascending else c.desc_nulls_last(), row)


# --- status columns ---------------------------------------------------------


def status_label(status: Column, order: Sequence[str] = K.STATUS_ORDER) -> Column:
    """Configured spelling of a status, whatever its case."""
    out = strip(status)
    label = None
    for name in order:
        hit = F.lower(strip(status)) == name.lower()
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return out if label is None else label.otherwise(out)


def status_days(records: DataFrame, order: Sequence[str] = K.STATUS_ORDER) -> DataFrame:
    """Most days per lead and status, in long form."""
    work = records
    if "analysis_level" in work.columns:
        work = work.filter(F.col("analysis_level") == "status")
    work = work.select(
        strip(F.col("lead_id")).alias("lead_id"),
        status_label(F.col("current_status"), order).alias("status"),
        F.col("days_on_stage").cast("double").alias("days"),
    )
    work = work.filter((F.col("lead_id") != "") & (F.col("status") != "") & F.col("days").isNotNull())
    return work.groupBy("lead_id", "status").agg(F.max("days").alias("days"))


def status_pivot(
    records: DataFrame,
    order: Sequence[str] = K.STATUS_ORDER,
    others: Sequence[str] = (),
) -> DataFrame:
    """Lead x status matrix of whole days for the given statuses.

    All statuses, known beforehand or not, are in `status_days`.
    """
    days = status_days(records, order)
    columns = [*order, *others]
    wide = days.groupBy("lead_id").pivot("status", columns).agg(F.max("days"))
    return wide.select("lead_id", *[F.bround(F.col(f"`{c}`")).cast("long").alias(c) for c in columns])


def attach_status_days(snapshot: DataFrame, pivot: DataFrame) -> DataFrame:
    """Status columns next to the snapshot."""
    replaced = [c for c in pivot.columns if c != "lead_id" and c in snapshot.columns]
    return snapshot.drop(*replaced).join(pivot, "lead_id", "left")


# --- dimension lists ----------------------------------------------------------


def dimensions(df: DataFrame, filter_columns: Sequence[str] = ()) -> DataFrame:
    """Distinct values of territories, groups and filter columns in one long table.

    One pass: rows are reduced to the distinct pairs before the shuffle.
    """
    names = list(dict.fromkeys(["tb", "product_group", *filter_columns]))
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).cast("string").alias("value")) for n in names])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()


def product_pairs(df: DataFrame) -> DataFrame:
    return df.select("product_group", "product").distinct()


def group_products(df: DataFrame) -> DataFrame:
    """Products of every group, sorted."""
    named = df.select(strip(F.col("product_group")).alias("product_group"), strip(F.col("product")).alias("product"))
    named = named.filter(
        (F.col("product_group") != "") & (F.col("product") != "") & (F.col("product") != K.GROUP_ONLY_PRODUCT)
    ).distinct()
    return named.groupBy("product_group").agg(F.array_sort(F.collect_set("product")).alias("products"))


def stage_map(df: DataFrame) -> DataFrame:
    """Deal stages that occur in every status, sorted, empty ones left out."""
    deal = F.when(~is_empty(F.col("deal_stage")), strip(F.col("deal_stage")))
    pairs = df.filter(F.col("current_status").isNotNull()).select("current_status", deal.alias("deal_stage")).distinct()
    return pairs.groupBy("current_status").agg(F.array_sort(F.collect_set("deal_stage")).alias("deal_stages"))


def manager_dimensions(detail: DataFrame) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit("product_group").alias("dimension"), F.col("product_group").alias("value")),
        F.struct(F.lit("product").alias("dimension"), F.col("product").alias("value")),
    )
    return detail.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()


