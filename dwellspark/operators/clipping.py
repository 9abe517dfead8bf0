"""Outlier clipping on the day histogram.

Rules run in order and each sees the rows the one before left. All of them only
cut at the two ends of a group's days, so the result of a whole rule list is one
interval of days per group; rows with unknown days always stay.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of the rules.
RANGE_MODES = ("range",)
PERCENTILE_MODES = ("percentile_trim", "trim", "percentile")
UNIQUE_MODES = ("unique_days_trim", "distinct_days_trim", "unique_value_trim")
IQR_MODES = ("iqr",)


def enabled_rules(rules: Sequence[dict[str, Any]]) -> list[dict[str, Any]]:
    out = []
    for i, rule in enumerate(rules, start=1):
        if isinstance(rule, dict) and rule.get("enabled", True):
            name = str(rule.get("name") or "").strip() or f"rule_{i}"
            out.append({**rule, "name": name, "mode": str(rule.get("mode", "range")).strip().lower()})
    return out


def audit_names(rules: Sequence[dict[str, Any]]) -> list[str]:
    return [
        "outlier_before",
        "outlier_after",
        "outlier_clipped_total",
        *[f"outlier_rule_{r['name']}" for r in enabled_rules(rules)],
    ]


def _in_scope(rule: dict[str, Any], keys: Sequence[str]) -> Column:
    """Groups a rule is meant for; an empty scope is every group."""
    out = F.lit(True)
    for key, wanted in (rule.get("scope") or {}).items():
        values = wanted if isinstance(wanted, list) else [wanted]
        texts = [str(v).strip().lower() for v in values if v is not None and str(v).strip()]
        if not texts:
            continue
        if key not in keys:
            return F.lit(False)
        out = out & F.coalesce(F.lower(F.trim(F.col(key).cast("string"))).isin(texts), F.lit(False))
    return out


def _number(value: Any) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def _limits(rule: dict[str, Any], group: Window, ordered: Window) -> dict[str, Column]:
    """Figures of the group that a rule needs, over the rows still kept."""
    live = F.col("kept") & F.col("day").isNotNull()
    day = F.when(live, F.col("day"))

    def percentile(share: float) -> Column:
        return F.percentile(day, F.lit(share), F.col("cnt")).over(group)

    mode = rule["mode"]
    leads = {"_leads": F.sum(F.when(live, F.col("cnt")).otherwise(0)).over(group)}
    if mode in PERCENTILE_MODES:
        low, high = _shares(rule)
        return {
            **leads,
            "_low": percentile(low / 100.0) if low > 0 else F.lit(None).cast("double"),
            "_high": percentile((100.0 - high) / 100.0) if high > 0 else F.lit(None).cast("double"),
        }
    if mode in IQR_MODES:
        return {**leads, "_low": percentile(0.25), "_high": percentile(0.75)}
    if mode in UNIQUE_MODES:
        return {
            **leads,
            "_days": F.count_if(live).over(group),
            "_place": F.count_if(live).over(ordered),
        }
    return {}


def _shares(rule: dict[str, Any]) -> tuple[float, float]:
    return _number(rule.get("trim_lower_pct")) or 0.0, _number(rule.get("trim_upper_pct")) or 0.0


def _outside(rule: dict[str, Any], min_size: int) -> Column:
    """Days a rule would remove, given the figures of `_limits`."""
    mode, day, low, high = rule["mode"], F.col("day"), F.col("_low"), F.col("_high")
    if mode in RANGE_MODES:
        least, most = _number(rule.get("min_days")), _number(rule.get("max_days"))
        below = F.lit(False) if least is None else day < least
        return below if most is None else below | (day > most)
    if mode in PERCENTILE_MODES:
        cut = F.coalesce(day < low, F.lit(False)) | F.coalesce(day > high, F.lit(False))
        return (F.col("_leads") >= max(min_size, 3)) & cut
    if mode in IQR_MODES:
        k = 1.5 if rule.get("iqr_k") is None else float(rule["iqr_k"])
        cut = (day < low - (high - low) * k) | (day > high + (high - low) * k)
        return (F.col("_leads") >= max(min_size, 4)) & (high > low) & cut
    if mode in UNIQUE_MODES:
        lower, upper = _shares(rule)
        days, place = F.col("_days"), F.col("_place")
        low_n = F.floor(days * F.lit(lower) / 100.0) if lower > 0 else F.lit(0)
        high_n = F.floor(days * F.lit(upper) / 100.0) if upper > 0 else F.lit(0)
        usable = (F.col("_leads") >= max(min_size, 3)) & (days >= 2) & (low_n + high_n < days)
        return usable & ((place <= low_n) | (place > days - high_n))
    warnings.warn(f"clipping rule {rule['name']!r}: unknown mode {mode!r}, nothing clipped", stacklevel=2)
    return F.lit(False)


def clip(
    hist: DataFrame,
    keys: Sequence[str],
    rules: Sequence[dict[str, Any]],
    min_group_size: int = 5,
    min_remaining: int = 3,
) -> DataFrame:
    """The histogram with `kept` and the audit of its group on every row.

    A rule that would leave fewer than `min_remaining` rows is skipped. All
    windows share one partitioning, so there is one shuffle of histogram rows.
    """
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(F.col("day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    work = hist.withColumns({"kept": F.lit(True), "outlier_before": F.sum("cnt").over(group)})
    names = []
    for rule in enabled_rules(rules):
        audit = f"outlier_rule_{rule['name']}"
        names.append(audit)
        floor = _number(rule.get("min_remaining"))
        floor = max(0, int(floor if floor is not None else min_remaining))
        limits = _limits(rule, group, ordered)
        work = work.withColumns(limits) if limits else work
        live = F.col("kept") & F.col("day").isNotNull()
        drop = live & _outside(rule, min_group_size) & _in_scope(rule, keys)
        work = work.withColumn("_drop", F.coalesce(drop, F.lit(False))).drop(*limits)
        work = work.withColumns(
            {
                "_left": F.sum(F.when(F.col("kept"), F.col("cnt")).otherwise(0)).over(group),
                "_cut": F.sum(F.when(F.col("_drop"), F.col("cnt")).otherwise(0)).over(group),
            }
        )
        does = (F.col("_cut") > 0) & (F.col("_left") - F.col("_cut") >= floor)
        work = work.withColumns(
            {
                audit: F.when(does, F.col("_cut")).otherwise(F.lit(0)),
                "kept": F.col("kept") & ~(does & F.col("_drop")),
            }
        )
    total = sum((F.col(n) for n in names), F.lit(0).cast("long"))
    return work.drop("_drop", "_left", "_cut").withColumns(
        {"outlier_clipped_total": total, "outlier_after": F.col("outlier_before") - total}
    )


def clip_bounds(
    hist: DataFrame,
    keys: Sequence[str],
    rules: Sequence[dict[str, Any]],
    min_group_size: int = 5,
    min_remaining: int = 3,
) -> DataFrame:
    """One row per group: the interval of days that stays, and the audit."""
    clipped = clip(hist, keys, rules, min_group_size, min_remaining)
    kept_day = F.when(F.col("kept"), F.col("day"))
    return clipped.groupBy(*keys).agg(
        F.min(kept_day).alias("low_day"),
        F.max(kept_day).alias("high_day"),
        *[F.max(n).alias(n) for n in audit_names(rules)],
    )
