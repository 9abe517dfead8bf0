"""Whole report runs: the tables of the report and of the dashboard.

A run is a dictionary of DataFrames. Only the parts that are asked for are
built; frames that several parts read are written once to reliable storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.output import json_safe
from dwellspark.operators import histogram as H
from dwellspark.operators import managers as M
from dwellspark.operators import matrix as X
from dwellspark.operators import pivots as P
from dwellspark.operators.exceedance import exceedance, exceedance_detail, exceedances, lead_records
from dwellspark.operators.filters import (
    apply_filters,
    excluded_stages,
    keep_expr,
    ordered_filters,
    rank_pool,
    terminal_rows_out,
)
from dwellspark.operators.funnel import (
    audit_summary,
    filter_catalog,
    funnel,
    group_funnel,
    norms_with_funnel,
    pipeline_filters,
)
from dwellspark.operators.norms import norms, norms_export
from dwellspark.operators.quality import RowCounts, lead_coverage, missing_days
from dwellspark.operators.slices import slice_catalog, sliced_records
from dwellspark.operators.snapshot import lead_snapshot, snapshot_export
from dwellspark.operators.teams import (
    attach_contacts,
    attach_leaders,
    compose_team,
    latest_leaders,
    split_team,
)
from dwellspark.operators.tracking import add_durations, lead_stage_records, manager_records
from dwellspark.session import materialise
from dwellspark.sources.sinks import slice_manifest, write_slices, write_table

RECORD = ("lead_id", "product_group", "product", "tb", "stage_key", "analysis_level")
SPOT = ("product_group", "product", "stage_key", "analysis_level")

DEFAULTS: dict[str, Any] = {
    "duration_source": "columns",
    "stage_analysis_mode": "status",
    "product_analysis_mode": "group_product",
    "dedup_same_date_agg": "max",
    "percentiles": (20, 50, 80),
    "exceedance_percentile": 80,
    "metrics": ("days_on_stage",),
    # Shown statistics per percentile, further choices of statistic columns, labels of columns.
    "profiles": None,
    "statistics": {},
    "labels": {},
    "chart_bars": 8,
    "filters": {},
    "filters_order": None,
    "source_filters": {},
    "source_filters_order": None,
    "clip_rules": (),
    "min_group_size": 5,
    "min_remaining": 3,
    "status_order": K.STATUS_ORDER,
    "stages_order": (),
    "matrix_layouts": (
        ("duration_matrix", "by_volume", False),
        ("duration_matrix_by_group", "group_alpha_product_volume", False),
        ("duration_matrix_by_status", "by_volume", True),
        ("duration_matrix_by_group_status", "group_alpha_product_volume", True),
    ),
    "max_day_span": None,
    "latest_only": True,
    "rank_by_team": True,
    "rank_selection": {},
    "top_managers": 3,
    "top_hotspots": 5,
    "top_stuck_items": 15,
    "max_distribution_points": None,
}


def report(
    reports: DataFrame,
    spec: dict[str, Any] | None = None,
    parts: Iterable[str] | None = None,
    team: DataFrame | tuple[DataFrame, DataFrame] | None = None,
    contacts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables of the report run, by name. `reports` is normalised and has a `seq` column."""
    s = {**DEFAULTS, **(spec or {})}
    filters, order = s["filters"], s["filters_order"]
    run_order = [f.name for f in pipeline_filters(filters, order)]
    raw = add_durations(reports, s["duration_source"])

    counts = RowCounts()

    @cache
    def rows() -> DataFrame:
        if "row_audit" not in wanted:
            return materialise(ordered_filters(raw, filters, run_order))
        # The write that is needed anyway counts the rows of every step.
        steps = pipeline_filters(filters, order)
        left, plain = counts.watch(raw, "loaded"), raw
        for spec in steps:
            keep = keep_expr(plain, spec)
            if keep is not None:
                left, plain = left.filter(keep), plain.filter(keep)
            left = counts.watch(left, spec.name, spec.description or spec.name)
        return materialise(left)

    def row_audit() -> DataFrame:
        return counts.table(rows().sparkSession)

    @cache
    def records() -> DataFrame:
        return materialise(
            lead_stage_records(
                rows(), s["stage_analysis_mode"], s["product_analysis_mode"], s["dedup_same_date_agg"]
            )
        )

    @cache
    def leaders(kind: str) -> DataFrame:
        roster = rosters(team)[0 if kind == "lead" else 1]
        found = latest_leaders(roster, f"{kind}_id")
        return materialise(attach_contacts(found, contacts) if contacts is not None else found)

    def with_people(df: DataFrame) -> DataFrame:
        if team is None:
            return df
        for kind in ("lead", "deal"):
            if f"{kind}_id" in df.columns:
                df = attach_leaders(df, leaders(kind), f"{kind}_id", kind).drop(f"{kind}_leaders")
        return df

    @cache
    def norm_table() -> DataFrame:
        return materialise(
            norms(
                records(), metrics=s["metrics"], percentiles=s["percentiles"], clip_rules=s["clip_rules"],
                min_group_size=s["min_group_size"], min_remaining=s["min_remaining"],
            )
        )

    @cache
    def audited_norms() -> DataFrame:
        if not run_order:
            return norm_table()
        return norms_with_funnel(norm_table(), group_funnel(raw, filters, order))

    @cache
    def snapshot() -> DataFrame:
        return materialise(exceedance(lead_snapshot(rows()), norm_table(), s["exceedance_percentile"]))

    @cache
    def entries() -> DataFrame:
        none = leaders_of_nobody(rows())
        found = M.manager_entries(
            snapshot(), leaders("lead") if team is not None else none, leaders("deal") if team is not None else none
        )
        return materialise(found) if {"manager_summary", "violations"} <= set(wanted) else found

    def with_mail(df: DataFrame) -> DataFrame:
        return df if contacts is None else attach_contacts(df, contacts)

    def snapshot_sheet() -> DataFrame:
        wide = P.status_pivot(records(), s["status_order"])
        status = [c for c in wide.columns if c != "lead_id"]
        return snapshot_export(with_people(P.attach_status_days(snapshot(), wide)), status_columns=status, labels=s["labels"])

    @cache
    def matrix(include_status: bool) -> DataFrame:
        return materialise(X.matrix_counts(snapshot(), include_status, s["max_day_span"]))

    builders = {
        "snapshot": snapshot_sheet,
        "status_days": lambda: P.status_days(records(), s["status_order"]),
        "norms": lambda: norms_export(
            audited_norms(), s["metrics"], s["percentiles"], s["profiles"], s["labels"], **s["statistics"]
        ),
        "funnel": lambda: funnel(raw, filters, order),
        "filter_catalog": lambda: filter_catalog(raw, filters, order),
        "audit_summary": lambda: audit_summary(audited_norms()),
        "manager_summary": lambda: with_mail(M.manager_summary(entries())),
        "violations": lambda: with_mail(M.violations(entries(), snapshot())),
        "lead_coverage": lambda: lead_coverage(rows(), snapshot()),
        "missing_days": lambda: missing_days(records()),
        "row_audit": row_audit,
        "source_export": lambda: with_people(
            ordered_filters(reports, s["source_filters"], s["source_filters_order"])
        ),
        "filtered_export": lambda: with_people(rows()),
    }
    for name, layout, include_status in s["matrix_layouts"]:
        builders[name] = lambda a=layout, b=include_status: X.duration_matrix(matrix(b), b, a, cut=lambda df: df)
    wanted = list(builders) if parts is None else list(parts)
    return _chosen(builders, wanted)


def rosters(team: DataFrame | tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Roster of the lead teams and of the deal teams: given as a pair, or one set with `team_type`."""
    return team if isinstance(team, tuple) else split_team(team)


def leaders_of_nobody(rows: DataFrame) -> DataFrame:
    """An empty leader table for runs without a roster."""
    text = F.lit(None).cast("string")
    return rows.filter(F.lit(False)).select(
        text.alias("id"), text.alias("name"), text.alias("tab_number"), text.alias("role"), text.alias("tb"), "seq"
    )


def _chosen(builders: dict[str, Callable[[], DataFrame]], parts: Iterable[str] | None) -> dict[str, DataFrame]:
    wanted = list(builders) if parts is None else list(parts)
    unknown = [p for p in wanted if p not in builders]
    if unknown:
        raise ValueError(f"unknown report parts: {unknown}; known: {sorted(builders)}")
    return {p: builders[p]() for p in wanted}


def dashboard(
    reports: DataFrame,
    spec: dict[str, Any] | None = None,
    team: DataFrame | tuple[DataFrame, DataFrame] | None = None,
    parts: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Tables behind the dashboard: slices, series, pivots, dimension lists and manager analysis.

    Only what the `parts` need is computed.
    """
    s = {**DEFAULTS, "metrics": ("days_on_stage", "days_since_deal"), **(spec or {})}
    filters = s["filters"]
    group_only = s["product_analysis_mode"] == "group_only"
    raw = add_durations(reports, s["duration_source"])
    clipping = {
        "clip_rules": s["clip_rules"], "min_group_size": s["min_group_size"], "min_remaining": s["min_remaining"],
    }
    keys = ["slice_key", "tb", "product_group", "product", "stage_key", "metric"]

    @cache
    def sliced() -> DataFrame:
        return materialise(sliced_records(raw, filters, **_tracking(s)))

    @cache
    def table() -> DataFrame:
        return materialise(
            norms(sliced(), SPOT, s["metrics"], s["percentiles"], km=None, tags=["slice_key"], **clipping)
        )

    @cache
    def hist() -> DataFrame:
        return materialise(H.series_histogram(sliced(), [k for k in keys if k not in ("tb", "metric")], s["metrics"]))

    builders = {
        "manifest": lambda: slice_manifest(sliced(), slice_catalog(raw.sparkSession, filters)),
        "pivot_flat": lambda: P.pivot_flat(table(), s["metrics"], s["percentiles"], group_only, tags=["slice_key"]),
        "distribution": lambda: H.distribution(hist(), keys),
        "series_summary": lambda: H.percentile_stats(hist(), keys, s["percentiles"], "days"),
        "stage_order": lambda: P.stage_order(sliced(), s["stages_order"], excluded_stages(filters)),
        "dimensions": lambda: P.dimensions(raw),
        "product_pairs": lambda: P.product_pairs(raw),
        "stage_map": lambda: P.stage_map(raw),
        "group_products": lambda: P.group_products(raw),
    }
    if s["max_distribution_points"]:
        builders["distribution_points"] = lambda: H.downsample(hist(), keys, s["max_distribution_points"])
    return _chosen(builders | _manager_builders(raw, s, team), parts)


def _tracking(s: dict[str, Any]) -> dict[str, Any]:
    return {
        "level": s["stage_analysis_mode"],
        "product_mode": s["product_analysis_mode"],
        "dedup_agg": s["dedup_same_date_agg"],
    }


def manager_analytics(
    raw: DataFrame, s: dict[str, Any], team: DataFrame | tuple[DataFrame, DataFrame] | None,
    parts: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Exceedances, rankings and charts of the managers, on the newest report date."""
    return _chosen(_manager_builders(raw, {**DEFAULTS, **s}, team), parts)


def _manager_builders(
    raw: DataFrame, s: dict[str, Any], team: DataFrame | tuple[DataFrame, DataFrame] | None
) -> dict[str, Callable[[], DataFrame]]:
    @cache
    def detail() -> DataFrame:
        rows = materialise(terminal_rows_out(apply_filters(raw, s["filters"]), s["filters"]))
        table = norms(
            lead_stage_records(rows, **_tracking(s)), SPOT, percentiles=s["percentiles"], clip_rules=s["clip_rules"],
            min_group_size=s["min_group_size"], min_remaining=s["min_remaining"], km=None,
        )
        latest = manager_records(rows, s["latest_only"], **_tracking(s))
        # Without teams the ranking is by manager, so records without one have no place in it.
        found = exceedance_detail(latest, materialise(table), s["exceedance_percentile"], need_km=not s["rank_by_team"])
        return materialise(found)

    @cache
    def totals() -> DataFrame:
        return M.manager_totals(detail())

    @cache
    def facts() -> DataFrame:
        return M.km_facts(detail())

    @cache
    def team_rows() -> DataFrame | None:
        if team is None or not s["rank_by_team"]:
            return None
        lead, deal = rosters(team)
        found = compose_team(
            detail(), latest_leaders(lead, "lead_id", True), latest_leaders(deal, "deal_id", True), list(RECORD)
        )
        return materialise(found)

    @cache
    def people() -> DataFrame:
        pool = rank_pool(detail(), **s["rank_selection"])
        return pool if team_rows() is None else materialise(M.explode_members(pool, team_rows(), list(RECORD)))

    @cache
    def top() -> DataFrame:
        return materialise(M.top_managers(M.manager_totals(people()), s["top_managers"]))

    def ranked() -> DataFrame:
        spots = materialise(M.hotspots(M.exceedances_by_product(people()), top(), s["top_hotspots"]))
        items = M.stuck_items(people(), spots, s["top_stuck_items"])
        return M.ranked_with_hotspots(top(), spots, items, team_rows(), list(RECORD))

    return {
        "lead_records": lambda: lead_records(detail()),
        "exceedances": lambda: exceedances(detail()),
        "manager_totals": totals,
        "detail_by_product": lambda: M.exceedances_by_product(detail()),
        "km_by_tb": lambda: M.violations_by_tb(totals()),
        "km_facts": facts,
        "km_by_segment": lambda: M.facts_by_segment(facts()),
        "km_charts": lambda: M.chart_groups(totals(), facts(), "km_by_tb", s["chart_bars"]),
        "manager_dimensions": lambda: P.manager_dimensions(detail()),
        "top_managers": ranked,
        "top_by_tb": lambda: M.top_grouped(top()),
    }


def write(
    tables: dict[str, DataFrame], path: str, fmt: str = "parquet", row_limit: int = 900_000,
    split_by: str | None = None, sep: str = ";", mode: str = "overwrite",
) -> None:
    """Write the tables of a run, each into its own folder, in the format asked for.

    With `split_by` the filtered export gets one folder per value of that column; files end at
    `row_limit` rows. Mode `replace` keeps the folders of values that this run does not have.
    """
    for name, df in tables.items():
        by = split_by if name == "filtered_export" and split_by in df.columns else None
        write_table(df, f"{path}/{name}", fmt, by, row_limit, sep, "overwrite" if by is None and mode == "replace" else mode)


def write_dashboard(
    tables: dict[str, DataFrame], path: str, split: bool = True, mode: str = "overwrite"
) -> None:
    """Dashboard data as JSON: the sliced tables by slice with their manifest, the others whole.

    Mode `replace` rewrites the slices that the manifest of these tables names and keeps the others.
    """
    write_slices(tables["pivot_flat"], tables["manifest"], f"{path}/pivot", split, mode)
    write_slices(tables["distribution"], tables["manifest"], f"{path}/distribution", split, mode)
    for name, df in tables.items():
        if name not in ("pivot_flat", "distribution", "manifest"):
            json_safe(df).write.mode("overwrite").json(f"{path}/{name}")
