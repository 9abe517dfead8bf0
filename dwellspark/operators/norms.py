"""Duration norms per territory and overall."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import is_empty, strip, whole_days
from dwellspark.operators.clipping import audit_names, clip
from dwellspark.operators.histogram import percentile_label, percentile_stats
from dwellspark.session import materialise

KEYS = ("product_group", "product", "current_status")

# Which columns of a percentile the norms table shows, and in which order.
SUFFIXES_LEFT = ("le_count", "days", "gt_count", "min", "max", "count", "km_count")
SUFFIXES = ("days", "le_count", "gt_count", "min", "max", "count", "km_count")
PROFILE_P80 = {"days", "le_count", "gt_count", "min", "max", "km_count"}
PROFILE_OTHER = {"days"}


def with_overall(df: DataFrame, tb: str = "tb", all_label: str = K.ALL_TERRITORIES) -> DataFrame:
    """Every row twice: for its territory and for all of them (`is_all`)."""
    scopes = F.array(
        F.struct(F.col(tb).alias("tb"), F.lit(False).alias("is_all")),
        F.struct(F.lit(all_label).alias("tb"), F.lit(True).alias("is_all")),
    )
    return df.withColumn("_scope", F.explode(scopes)).withColumns(
        {tb: F.col("_scope.tb"), "is_all": F.col("_scope.is_all")}
    ).drop("_scope")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"r_{k}"]) for k in keys])


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join in which a missing key equals a missing key."""
    r = right.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(r, _same(left, r, keys), how).drop(*[f"r_{k}" for k in keys])


def norms(
    records: DataFrame,
    keys: Sequence[str] = KEYS,
    metrics: Sequence[str] = ("days_on_stage",),
    percentiles: Sequence[float] = (20, 50, 80),
    clip_rules: Sequence[dict[str, Any]] = (),
    clip_metric: str = "days_on_stage",
    min_group_size: int = 5,
    min_remaining: int = 3,
    km: str | None = "km",
    tb: str | None = "tb",
    all_label: str = K.ALL_TERRITORIES,
    tags: Sequence[str] = (),
    cut: Callable[[DataFrame], DataFrame] = materialise,
) -> DataFrame:
    """Norms per group, with and without territory, after clipping.

    The records are read once. Where managers or a second metric need them
    again, their keys, manager and days are written to reliable storage by
    `cut`, one row each: nearly every record would be a count of its own there,
    and counting them an exchange of all. Everything else works on counts per
    group and day. `tags` are further group keys.
    """
    keys = [*tags, *keys]
    km = km if km and km in records.columns and any(float(p) == 80.0 for p in percentiles) else None
    day_of = {m: f"_d{i}" for i, m in enumerate(dict.fromkeys([clip_metric, *metrics]))}
    work = records.withColumns({d: whole_days(F.col(m)) for m, d in day_of.items()})
    fine = [*([tb] if tb else []), *keys]
    managers = []
    if km:
        name = strip(F.col(km))
        work = work.withColumn("_km", F.when(~is_empty(name, K.EMPTY_MANAGER), name))
        managers = ["_km"]
    work = work.select(*fine, *managers, *day_of.values())
    if km or len(day_of) > 1:
        # Used several times below; the records behind it are not read again.
        work = cut(work)
    group = ["is_all", tb, *keys] if tb else list(keys)

    def scoped(df: DataFrame) -> DataFrame:
        return with_overall(df, tb, all_label) if tb else df

    counts = work.groupBy(*fine, F.col(day_of[clip_metric]).alias("day")).agg(F.count(F.lit(1)).alias("cnt"))
    hist = scoped(counts).groupBy(*group, "day").agg(F.sum("cnt").alias("cnt"))
    hist = clip(hist, group, clip_rules, min_group_size, min_remaining)
    kept = F.when(F.col("kept"), F.col("cnt")).otherwise(F.lit(0))
    audits = audit_names(clip_rules) if clip_rules else []
    ends = [
        F.min(F.when(F.col("kept"), F.col("day"))).alias("_low"),
        F.max(F.when(F.col("kept"), F.col("day"))).alias("_high"),
    ]
    once = [*[F.max(a).alias(a) for a in audits], *ends]
    table = percentile_stats(
        hist.withColumn("cnt", kept), group, percentiles, clip_metric, once
    )
    others = [m for m in metrics if m != clip_metric]
    if km or others:
        table = cut(table)
        inside = attach(scoped(work), table.select(*group, "_low", "_high", *_thresholds(table, km)), group, "inner")
        first = F.col(day_of[clip_metric])
        inside = inside.filter(first.isNull() | first.between(F.col("_low"), F.col("_high")))
        if km and clip_metric in metrics:
            table = attach(table, _km_counts(inside, group, clip_metric, day_of[clip_metric]), group)
        for metric in others:
            day = day_of[metric]
            h = inside.groupBy(*group, F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("cnt"))
            stats = percentile_stats(h, group, percentiles, metric)
            if km:
                # Written first: Spark then knows that it is small and deals no records for this join.
                stats = cut(stats)
                limit = stats.select(*group, f"{metric}_p80_days")
                over = attach(inside, limit, group, "inner")
                stats = attach(stats, _km_counts(over, group, metric, day), group)
            table = attach(table, stats, group)
    counts = [c for c in table.columns if c.endswith("_count")]
    table = table.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in counts})
    measures = [c for m in metrics for c in table.columns if c.startswith(f"{m}_")]
    return table.select(*group, *measures, *audits)


def _thresholds(table: DataFrame, km: str | None) -> list[str]:
    return [c for c in table.columns if km and c.endswith("_p80_days")]


def _km_counts(inside: DataFrame, group: Sequence[str], metric: str, day: str) -> DataFrame:
    """Managers with at least one kept stay that reaches the norm."""
    reached = inside.filter(F.col("_km").isNotNull() & (F.col(day) >= F.col(f"{metric}_p80_days")))
    return reached.groupBy(*group).agg(F.count_distinct("_km").alias(f"{metric}_p80_km_count"))


def stats_by_group(records: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Statistics on exactly the given keys, without a second scope."""
    return norms(records, keys, tb=None, **options)


def one_territory(table: DataFrame, tb: str) -> DataFrame:
    """The norms of one territory."""
    return table.filter(~F.col("is_all") & (F.col("tb") == tb)).drop("tb", "is_all")


def active_percentiles(profiles: Sequence[dict[str, Any]], default: Sequence[float] = (20, 50, 80)) -> list[float]:
    chosen = [float(p["p"]) for p in profiles if p.get("compute", True)]
    return chosen or [float(p) for p in default]


def export_columns(
    metric: str,
    percentiles: Sequence[float] = (20, 50, 80),
    profiles: dict[float, set[str]] | None = None,
    show_min: bool = True,
    show_max: bool = True,
    counts_left: bool = True,
) -> list[str]:
    """Statistic columns of a metric in the order of the norms sheet."""
    profiles = profiles or {}
    columns = [f"{metric}_min"] * show_min + [f"{metric}_max"] * show_max + [f"{metric}_count"]
    for p in percentiles:
        shown = profiles.get(float(p), PROFILE_P80 if float(p) == 80.0 else PROFILE_OTHER)
        order = SUFFIXES_LEFT if counts_left else SUFFIXES
        columns += [f"{metric}_{percentile_label(p)}_{s}" for s in order if s in shown]
    return columns


def norms_export(
    table: DataFrame,
    metrics: Sequence[str] = ("days_on_stage",),
    percentiles: Sequence[float] = (20, 50, 80),
    profiles: dict[float, set[str]] | None = None,
    labels: dict[str, str] | None = None,
    **options,
) -> DataFrame:
    """Norms sheet: keys, chosen statistics, filter audit, clipping audit, under their labels."""
    labels = labels or {}
    technical = ("is_all", "analysis_level", "stage_key")
    statistics = [c for m in metrics for c in export_columns(m, percentiles, profiles, **options)]
    audits = [c for c in table.columns if c.startswith("filter_")]
    audits += [c for c in table.columns if c.startswith("outlier_")]
    measures = tuple(f"{m}_" for m in metrics)
    keys = [
        c for c in table.columns
        if c not in technical and c not in audits and not c.startswith(measures)
    ]
    shown = [*keys, *[c for c in statistics if c in table.columns], *audits]
    return table.select(*[F.col(c).alias(labels.get(c, c)) for c in shown])


def stats_nested(
    table: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str] = ("days_on_stage",),
    percentiles: Sequence[float] = (20, 50, 80),
) -> DataFrame:
    """Statistics as nested records: metrics.<metric>.percentiles.<label>.<part>."""
    per_metric = []
    for m in metrics:
        shares = []
        for p in percentiles:
            label = percentile_label(p)
            parts = [s for s in SUFFIXES if f"{m}_{label}_{s}" in table.columns]
            shares.append(F.struct(*[F.col(f"{m}_{label}_{s}").alias(s) for s in parts]).alias(label))
        per_metric.append(
            F.struct(
                F.col(f"{m}_min").alias("min"),
                F.col(f"{m}_max").alias("max"),
                F.col(f"{m}_count").alias("count"),
                F.struct(*shares).alias("percentiles"),
            ).alias(m)
        )
    return table.select(*keys, F.struct(*per_metric).alias("metrics"))


def stats_variant(
    table: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str] = ("days_on_stage",),
    percentiles: Sequence[float] = (20, 50, 80),
) -> DataFrame:
    """The nested records as one variant column: runs with other metrics or percentiles keep the schema."""
    nested = stats_nested(table, keys, metrics, percentiles)
    return nested.withColumn("metrics", F.to_variant_object("metrics"))


def statistic(metric: str, part: str, percentile: float | None = None, column: str = "metrics", kind: str = "long") -> Column:
    """One number of a variant by its path; null if the run did not compute it."""
    inner = f"percentiles.{percentile_label(percentile)}." if percentile is not None else ""
    return F.try_variant_get(F.col(column), f"$.{metric}.{inner}{part}", kind)
