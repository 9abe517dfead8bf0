"""Filter funnel: how many rows and leads every filter of a chain removes.

All steps come from one pass. A row gets the number of consecutive filters it
passes; a step's counts follow from that number, so no filtered copy is counted
again and no distinct count is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import strip
from dwellspark.operators.filters import (
    FilterSpec,
    chain,
    enabled_in_order,
    filter_specs,
    filters_order,
    keep_expr,
)


def pipeline_filters(
    filters: dict[str, dict[str, Any]], order: Sequence[str] | None = None
) -> list[FilterSpec]:
    """Enabled filters in the order in which the run applies them."""
    specs = filter_specs(filters)
    return enabled_in_order(specs, filters_order(specs, order))


def with_survival(df: DataFrame, specs: Sequence[FilterSpec]) -> tuple[DataFrame, list[FilterSpec]]:
    """Add `survived`, the number of consecutive filters a row passes, and name the filters used."""
    used: list[FilterSpec] = []
    keeps: list[Column] = []
    for spec in specs:
        # An extreme is taken over the rows that the filters before it leave.
        left = chain(df, used) if spec.is_extreme else df
        keep = keep_expr(left, spec)
        if keep is not None:
            used.append(spec)
            keeps.append(F.coalesce(keep, F.lit(False)))
    survived = F.lit(len(keeps))
    for i in range(len(keeps) - 1, -1, -1):
        survived = F.when(~keeps[i], F.lit(i)).otherwise(survived)
    return df.withColumn("survived", survived), used


def _lead(name: str) -> Column:
    return F.when(strip(F.col(name)) != "", strip(F.col(name)))


def funnel(
    df: DataFrame,
    filters: dict[str, dict[str, Any]],
    order: Sequence[str] | None = None,
    lead: str = "lead_id",
) -> DataFrame:
    """One row per filter: rows and distinct leads before, after and dropped."""
    counted, used = with_survival(df, pipeline_filters(filters, order))
    return _funnel_rows(counted, used, lead)


def _funnel_rows(counted: DataFrame, used: Sequence[FilterSpec], lead: str) -> DataFrame:
    steps = range(len(used) + 1)
    per_lead = counted.groupBy(_lead(lead).alias("lead")).agg(
        F.max("survived").alias("best"),
        *[F.count_if(F.col("survived") >= i).alias(f"rows_{i}") for i in steps],
    )
    totals = per_lead.agg(
        *[F.coalesce(F.sum(f"rows_{i}"), F.lit(0)).alias(f"rows_{i}") for i in steps],
        *[
            F.count_if(F.col("lead").isNotNull() & (F.col("best") >= i)).alias(f"leads_{i}")
            for i in steps
        ],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(spec.name).alias("filter_name"),
            F.lit(spec.description).alias("description"),
            F.lit("exclude" if spec.excludes else "filter").alias("kind"),
            F.col(f"rows_{i}").alias("before_rows"),
            F.col(f"rows_{i + 1}").alias("after_rows"),
            (F.col(f"rows_{i}") - F.col(f"rows_{i + 1}")).alias("dropped_rows"),
            F.col(f"leads_{i}").alias("before_leads"),
            F.col(f"leads_{i + 1}").alias("after_leads"),
            (F.col(f"leads_{i}") - F.col(f"leads_{i + 1}")).alias("dropped_leads"),
        )
        for i, spec in enumerate(used)
    ]
    return totals.select(F.inline(F.array(*rows)))


def group_funnel(
    df: DataFrame,
    filters: dict[str, dict[str, Any]],
    order: Sequence[str] | None = None,
    keys: Sequence[str] = ("product_group", "product", "current_status"),
    tb: str = "tb",
    lead: str = "lead_id",
    all_label: str = K.ALL_TERRITORIES,
) -> DataFrame:
    """Distinct leads per group before, dropped by each filter and after.

    With and without territory; `is_all` marks the rows without.
    """
    counted, used = with_survival(df, pipeline_filters(filters, order))
    best = (
        counted.withColumn("lead", _lead(lead))
        .filter(F.col("lead").isNotNull())
        .groupBy(tb, *keys, "lead")
        .agg(F.max("survived").alias("best"))
    )
    by_tb = best.groupBy(tb, *keys).agg(*_step_counts(used)).withColumn("is_all", F.lit(False))
    overall = (
        best.groupBy(*keys, "lead")
        .agg(F.max("best").alias("best"))
        .groupBy(*keys)
        .agg(*_step_counts(used))
        .select(F.lit(all_label).alias(tb), "*", F.lit(True).alias("is_all"))
    )
    both = by_tb.unionByName(overall)
    return both.select(
        "is_all",
        tb,
        *keys,
        F.col("reached_0").alias("filter_before"),
        *[
            (F.col(f"reached_{i}") - F.col(f"reached_{i + 1}")).alias(f"filter_dropped_{s.name}")
            for i, s in enumerate(used)
        ],
        F.col(f"reached_{len(used)}").alias("filter_after"),
    )


def _step_counts(used: Sequence[FilterSpec]) -> list[Column]:
    return [F.count_if(F.col("best") >= i).alias(f"reached_{i}") for i in range(len(used) + 1)]


def audit_names(filters: dict[str, dict[str, Any]], order: Sequence[str] | None = None) -> list[str]:
    """Names of the audit columns in the order of the norms table."""
    names = [s.name for s in pipeline_filters(filters, order)]
    return ["filter_before", *[f"filter_dropped_{n}" for n in names], "filter_after"] if names else []


def norms_with_funnel(
    norms: DataFrame,
    audit: DataFrame,
    keys: Sequence[str] = ("product_group", "product", "current_status"),
    tb: str = "tb",
) -> DataFrame:
    """Norms with the audit of their group; groups without an audit get zeros."""
    added = [c for c in audit.columns if c.startswith("filter_")]
    on = ["is_all", tb, *keys]
    right = audit.select(*[F.col(c).alias(f"a_{c}") for c in on], *added)
    match = reduce(lambda a, b: a & b, [norms[c].eqNullSafe(right[f"a_{c}"]) for c in on])
    joined = norms.join(right, match, "left")
    return joined.select(
        *norms.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in added]
    )


def filter_catalog(
    df: DataFrame,
    filters: dict[str, dict[str, Any]],
    order: Sequence[str] | None = None,
    lead: str = "lead_id",
) -> DataFrame:
    """Every filter with its settings, and the funnel counts of those that ran."""
    specs = filter_specs(filters)
    names = [n for n in dict.fromkeys([*(order or specs), *specs]) if n in specs]
    rows = [
        (
            i,
            n,
            specs[n].description,
            "yes" if specs[n].enabled else "no",
            specs[n].action,
            specs[n].match,
            specs[n].columns[0] if specs[n].columns else "",
            _values_text(specs[n]),
            specs[n].values_mode,
            specs[n].value_type,
        )
        for i, n in enumerate(names, start=1)
    ]
    settings = df.sparkSession.createDataFrame(
        rows,
        "position int, filter_name string, description string, enabled string, action string, "
        "match string, column_key string, filter_values string, values_mode string, value_type string",
    )
    counts = funnel(df, filters, order, lead).drop("step", "description", "kind")
    return settings.join(counts, "filter_name", "left")


def _values_text(spec: FilterSpec) -> str:
    if spec.values:
        return ", ".join(str(v) for v in spec.values)
    return f"({spec.match})" if spec.is_extreme else "—"


def audit_summary(norms: DataFrame) -> DataFrame:
    """Totals of the filter and clipping audit over all groups of the norms table."""
    audited = [c for c in norms.columns if c.startswith(("filter_", "outlier_"))]
    totals = norms.agg(
        F.count(F.lit(1)).alias("groups"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in audited],
    )
    pairs = [
        F.struct(F.lit(c).alias("indicator"), F.col(c).alias("total")) for c in ["groups", *audited]
    ]
    return totals.select(F.inline(F.array(*pairs)))
