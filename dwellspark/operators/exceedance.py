"""Leads over their norm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import client_name, is_empty, person_name, strip, territory_manager_key, whole_days
from dwellspark.operators.histogram import percentile_label
from dwellspark.operators.norms import KEYS, attach


def thresholds(
    table: DataFrame, overall: bool, percentile: float = 80, keys: Sequence[str] = KEYS,
    metric: str = "days_on_stage", tb: str = "tb",
) -> DataFrame:
    """Norm per group out of the norms table, of one scope."""
    value = F.col(f"{metric}_{percentile_label(percentile)}_days")
    scope = table.filter(F.col("is_all") == overall)
    return scope.select(*([] if overall else [tb]), *keys, value.alias("threshold_days"))


def exceedance(
    snapshot: DataFrame,
    table: DataFrame,
    percentile: float = 80,
    scope: str = "tb_then_overall",
    round_days: bool = True,
    keys: Sequence[str] = KEYS,
    days: str = "days_on_stage",
    metric: str = "days_on_stage",
    tb: str = "tb",
) -> DataFrame:
    """Norm, current days, flag and days over the norm for every lead.

    The norm of the territory counts, else the overall one. Over the norm means
    strictly more days.
    """
    overall = thresholds(table, True, percentile, keys, metric).withColumnRenamed("threshold_days", "_all_days")
    out = snapshot
    if scope == "tb_then_overall":
        local = thresholds(table, False, percentile, keys, metric, tb)
        local = local.withColumnRenamed("threshold_days", "_tb_days")
        out = attach(out, local, [tb, *keys])
    else:
        out = out.withColumn("_tb_days", F.lit(None).cast("long"))
    out = attach(out, overall, keys)
    current = F.bround(F.col(days).cast("double")) if round_days else F.col(days).cast("double")
    out = out.withColumns({"norm_days": F.coalesce("_tb_days", "_all_days"), "current_days": current})
    over = F.coalesce(F.col("current_days") > F.col("norm_days"), F.lit(False))
    return out.drop("_tb_days", "_all_days").withColumns(
        {
            "exceeded": over,
            "exceeded_flag": F.when(over, F.lit(K.EXCEEDED_FLAG)),
            "exceeded_days": F.when(over, F.col("current_days") - F.col("norm_days")),
        }
    )


DETAIL_FIELDS = (
    "tb",
    "km",
    "product_group",
    "product",
    "stage_key",
    "analysis_level",
    "lead_id",
    "days_int",
    "threshold_days",
    "exceeded",
    "label",
    "deal_id",
    "inn",
    "client",
    "change_conditions",
    "efs_flag",
    "vks",
)


def exceedance_detail(
    records: DataFrame,
    table: DataFrame,
    percentile: float = 80,
    keys: Sequence[str] = ("product_group", "product", "stage_key", "analysis_level"),
    metric: str = "days_on_stage",
    need_km: bool = False,
) -> DataFrame:
    """Lead-stage records against the overall norm, on the days as they are."""
    norm = thresholds(table, True, percentile, keys, metric).filter(F.col("threshold_days").isNotNull())
    joined = attach(records, norm, keys)
    joined = joined.withColumn("days_int", F.col(metric).cast("double"))
    over = F.coalesce(F.col("days_int") > F.col("threshold_days"), F.lit(False))
    out = joined.withColumn("exceeded", over)
    if need_km:
        out = out.filter(~is_empty(F.col("km"), K.EMPTY_MANAGER))
    return out.select(*[c for c in DETAIL_FIELDS if c in out.columns])


def lead_records(detail: DataFrame) -> DataFrame:
    """All records for the dashboard; identity only where the norm is exceeded."""
    out = detail.withColumns(
        {
            "days_int": F.bround("days_int", 1),
            "threshold_days": F.bround(F.col("threshold_days").cast("double"), 1),
            "km_tb_key": territory_manager_key(F.col("tb"), F.col("km")),
        }
    )
    cleaned = {
        "client": client_name(F.col("client")) if "client" in out.columns else None,
        "inn": F.when(strip(F.col("inn")) != "", strip(F.col("inn"))) if "inn" in out.columns else None,
        "vks": person_name(F.col("vks")) if "vks" in out.columns else None,
        "deal_id": F.col("deal_id") if "deal_id" in out.columns else None,
    }
    return out.withColumns(
        {name: F.when(F.col("exceeded"), value) for name, value in cleaned.items() if value is not None}
    )


def exceedances(detail: DataFrame) -> DataFrame:
    """Only the exceeded records, with the overshoot."""
    over = F.greatest(F.coalesce("days_int", F.lit(0.0)) - F.coalesce("threshold_days", F.lit(0.0)), F.lit(0.0))
    return lead_records(detail.filter("exceeded")).withColumn("overshoot", F.bround(over, 1))
