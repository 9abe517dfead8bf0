"""One record per lead and stage out of dated report rows.

Everything is a two-step aggregation with partial aggregates before each
shuffle, so that a lead with a large share of all rows does not end in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.dates import stage_days
from dwellspark.functions.text import is_empty
from dwellspark.operators.filters import latest_rows

EXTRA_FIELDS = ("deal_id", "inn", "client", "change_conditions", "efs_flag", "vks", "km", "label")


def add_durations(df: DataFrame, source: str = "columns", fallback: bool = True) -> DataFrame:
    """`days_on_stage` and `days_since_deal` from the columns or from the dates."""
    if source == "columns":
        return df
    stage = stage_days(
        F.col("report_date"), F.col("work_start_date"), F.col("deal_created_date"), F.col("deal_stage")
    )
    deal = F.datediff("report_date", "deal_created_date").cast("double")
    if fallback:
        stage = F.coalesce(stage, F.col("days_on_stage").cast("double"))
        deal = F.coalesce(deal, F.col("days_since_deal").cast("double"))
    return df.withColumns({"days_on_stage": stage, "days_since_deal": deal})


def first_value(name: str, seq: str = "seq") -> Column:
    """First value that is not null, in row order."""
    return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(seq)))


def record_keys(level: str, group_only: bool) -> list[str]:
    stage = "deal_stage" if level == "substage" else "current_status"
    return ["lead_id", "product_group", *([] if group_only else ["product"]), "tb", stage]


def dedup_same_date(
    df: DataFrame,
    level: str = "status",
    group_only: bool = False,
    agg: str = "max",
    seq: str = "seq",
    tags: Sequence[str] = (),
) -> DataFrame:
    """One row per lead, stage and report date: days by `agg`, first value of the rest."""
    if level == "substage":
        df = df.filter(~is_empty(F.col("deal_stage")))
    keys = [*tags, *record_keys(level, group_only), "report_date"]
    fields = ["current_status", "deal_stage", "product", *EXTRA_FIELDS]
    metrics = [m for m in ("days_on_stage", "days_since_deal") if m in df.columns]
    return df.groupBy(*keys).agg(
        *[_aggregate(agg, m, seq).alias(m) for m in metrics],
        *[first_value(c, seq).alias(c) for c in fields if c in df.columns and c not in keys],
    )


def _aggregate(agg: str, name: str, seq: str) -> Column:
    if agg == "first":
        return first_value(name, seq)
    if agg == "last":
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(seq)))
    known = {"max": F.max, "min": F.min, "mean": F.avg, "median": F.median, "sum": F.sum}
    return known[agg](name)


def _state(agg: str, name: str, seq: str) -> Column:
    """What has to be known of some rows to go on with the rest of them."""
    value = F.col(name)
    if agg in ("first", "last"):
        placed = F.when(value.isNotNull(), F.struct(F.col(seq).alias("at"), value.alias("v")))
        return F.min(placed) if agg == "first" else F.max(placed)
    if agg == "mean":
        return F.struct(F.sum(value).alias("sum"), F.count(value).alias("n"))
    return _aggregate(agg, name, seq)


def _merged(agg: str, name: str) -> Column:
    """The aggregate over states of the same name."""
    if agg in ("first", "last"):
        return (F.min(name) if agg == "first" else F.max(name))["v"]
    if agg == "mean":
        return F.sum(F.col(name)["sum"]) / F.when(F.sum(F.col(name)["n"]) > 0, F.sum(F.col(name)["n"]))
    return _aggregate(agg, name, "")


def daily_states(
    df: DataFrame, level: str, group_only: bool, agg: str, seq: str, tags: Sequence[str]
) -> DataFrame:
    """`dedup_same_date` in the form of states, which `merged_states` can bring together on fewer tags."""
    if level == "substage":
        df = df.filter(~is_empty(F.col("deal_stage")))
    keys = [*tags, *record_keys(level, group_only), "report_date"]
    fields = ["current_status", "deal_stage", "product", *EXTRA_FIELDS]
    metrics = [m for m in ("days_on_stage", "days_since_deal") if m in df.columns]
    return df.groupBy(*keys).agg(
        *[_state(agg, m, seq).alias(m) for m in metrics],
        *[_state("first", c, seq).alias(c) for c in fields if c in df.columns and c not in keys],
    )


def merged_states(states: DataFrame, level: str, group_only: bool, agg: str, tags: Sequence[str]) -> DataFrame:
    """One row per lead, stage and report date, as from `dedup_same_date`."""
    keys = [*tags, *record_keys(level, group_only), "report_date"]
    metrics = ("days_on_stage", "days_since_deal")
    return states.groupBy(*keys).agg(
        *[_merged(agg if c in metrics else "first", c).alias(c) for c in states.columns if c not in keys]
    )


def best_records(daily: DataFrame, level: str, group_only: bool, tags: Sequence[str]) -> DataFrame:
    """Across dates: most days first, then the newest date."""
    keys = [*tags, *record_keys(level, group_only)]
    rest = [c for c in daily.columns if c not in keys]
    # Nulls are the smallest in a struct. A date is there once, so what follows it decides nothing.
    order = ("days_on_stage", "report_date")
    best = daily.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("best"))
    flat = best.select(*keys, *[F.col("best")[c].alias(c) for c in rest])
    stage = "deal_stage" if level == "substage" else "current_status"
    out = flat.withColumns({"analysis_level": F.lit(level), "stage_key": F.col(stage)})
    if level != "substage":
        # A status has no step; the column stands behind the durations.
        ahead = [c for c in flat.columns if c in (*keys, "report_date", "days_on_stage", "days_since_deal")]
        behind = [c for c in out.columns if c not in (*ahead, "deal_stage")]
        out = out.select(*ahead, F.lit("").alias("deal_stage"), *behind)
    return out.withColumn("product", F.lit(K.GROUP_ONLY_PRODUCT)) if group_only else out


#: Names of the levels of analysis.
LEVELS = {"status": ("status",), "substages": ("substage",), "substage": ("substage",), "both": ("status", "substage")}


def levels_of(level: str) -> tuple[str, ...]:
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; known: {sorted(LEVELS)}")
    return LEVELS[level]


def lead_stage_records(
    df: DataFrame,
    level: str = "status",
    product_mode: str = "group_product",
    dedup_agg: str = "max",
    seq: str = "seq",
    tags: Sequence[str] = (),
) -> DataFrame:
    """One record per lead, product, territory and stage.

    `level` is status, substages (or substage) or both; `tags` are further keys such as
    `slice_key`. Records without days stay.
    """
    group_only = product_mode == "group_only"
    tags = list(tags)
    parts = []
    for lv in levels_of(level):
        # Records of a status show no step of the deal, so none is looked for.
        used = df if lv == "substage" else df.drop("deal_stage")
        parts.append(best_records(dedup_same_date(used, lv, group_only, dedup_agg, seq, tags), lv, group_only, tags))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def manager_records(df: DataFrame, latest_only: bool = True, **options) -> DataFrame:
    """Records for the manager analysis, by default from the newest report date only."""
    return lead_stage_records(latest_rows(df) if latest_only else df, **options)
