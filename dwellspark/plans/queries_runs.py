"""Tables of whole report and dashboard runs, checked by the SQL of the operators behind them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dwellspark.operators.norms import norms
from dwellspark.operators.slices import slice_catalog
from dwellspark.operators.tracking import lead_stage_records
from dwellspark.plans.fixtures import event_reports, stage_reports
from dwellspark.plans.queries_filters import SWITCHES
from dwellspark.plans.queries_norms import stats_sql
from dwellspark.plans.queries_series import SERIES
from dwellspark.plans.queries_tracking import slice_records
from dwellspark.plans.registry import ORACLE, QUERIES, cte, query
from dwellspark.plans.report import dashboard, report
from dwellspark.plans.settings import CLIP_RULES, FILTERS, KEYS, ORDER, STEPS_SQL, UNIQUE_RULE
from dwellspark.session import materialise, run_folder
from dwellspark.sources.sinks import read_slices, slice_manifest, write_slices

SWITCHED = ("even_lines", "no_unspecified", "red_parts", "spring_parts", "from_1998")
SPEC = {
    "filters": FILTERS,
    "filters_order": ORDER,
    "clip_rules": CLIP_RULES,
    "profiles": {80.0: {"days", "le_count", "gt_count", "km_count"}},
    "labels": {"tb": "Territory", "days_on_stage_count": "Leads", "days_on_stage_p80_days": "P80"},
}


def _run_query(name: str, like: str, table):
    """A table of a run that has to equal the result of the single operator."""
    QUERIES[name] = table
    ORACLE[name] = ORACLE[like]


def _report(part: str):
    return lambda spark, sf: report(stage_reports(spark, sf), SPEC, [part])[part]


_run_query("q_report_norms", "q_norms_export", _report("norms"))
_run_query("q_report_funnel", "q_funnel", _report("funnel"))
_run_query("q_report_filter_catalog", "q_filter_catalog", _report("filter_catalog"))
_run_query("q_report_audit_summary", "q_audit_summary", _report("audit_summary"))

SLICED = {"filters": {n: FILTERS[n] for n in SWITCHED}}
# All dates and managers by name, as the single operators are checked.
MANAGERS = {"filters": FILTERS, "latest_only": False, "chart_bars": 3}


def _dashboard(part: str, spec: dict):
    return lambda spark, sf: dashboard(stage_reports(spark, sf), spec, parts=[part])[part]


_run_query("q_dashboard_manifest", "q_slice_manifest", _dashboard("manifest", SLICED))
for _part, _like in (
    ("manager_totals", "q_manager_totals"),
    ("detail_by_product", "q_exceed_by_product"),
    ("km_by_tb", "q_km_by_tb"),
    ("km_facts", "q_km_facts"),
    ("km_by_segment", "q_facts_by_segment"),
):
    _run_query(f"q_dashboard_{_part}", _like, _dashboard(_part, MANAGERS))

# Series of every slice: the single series with the slice as one more key.
_SLICE_SERIES = ("slice_key", *SERIES)
_S = ", ".join(_SLICE_SERIES)
cte(
    "slse",
    """SELECT slice_key, tb, product_group, product, stage_key, metric, d FROM
         (SELECT slice_key, unnest([tb, '__ALL__']) AS tb, product_group, product, stage_key, days_on_stage, days_since_deal
          FROM sl_rec)
         CROSS JOIN LATERAL (SELECT 'days_on_stage' AS metric, cast(round_even(days_on_stage, 0) AS bigint) AS d
            UNION ALL SELECT 'days_since_deal', cast(round_even(days_since_deal, 0) AS bigint))""",
)
cte("slh", f"SELECT {_S}, d AS day, count(*) AS cnt FROM slse GROUP BY {_S}, d")


@query(
    "q_dashboard_distribution",
    f"""SELECT {_S}, day, cnt, cast(sum(cnt) OVER (w ORDER BY day) AS bigint) - cnt + 1 AS first_lead,
        cast(sum(cnt) OVER (w ORDER BY day) AS bigint) AS last_lead, cast(sum(cnt) OVER w AS bigint) AS total_leads
        FROM slh WINDOW w AS (PARTITION BY {_S})""",
)
def q_dashboard_distribution(spark, sf):
    return _dashboard("distribution", SLICED)(spark, sf)


@query("q_dashboard_series_summary", stats_sql("slse", _SLICE_SERIES, "days", "d"))
def q_dashboard_series_summary(spark, sf):
    return _dashboard("series_summary", SLICED)(spark, sf)


@query(
    "q_report_row_audit",
    " UNION ALL ".join(
        f"""SELECT {i} AS step_no, '{name}' AS step, b AS rows_before, a AS rows_after, b - a AS dropped,
            {reason} AS reason, false AS unexplained
            FROM (SELECT count(*) FILTER ({before}) AS b, count(*) FILTER ({after}) AS a FROM sr)"""
        for i, (name, before, after, reason) in enumerate(
            [("loaded", "true", "true", "NULL")]
            + [
                (
                    name,
                    " AND ".join(["true", *[STEPS_SQL[n] for n in ORDER[:k]]]),
                    " AND ".join(STEPS_SQL[n] for n in ORDER[: k + 1]),
                    f"'{FILTERS[name].get('description') or name}'",
                )
                for k, name in enumerate(ORDER)
            ]
        )
    ),
)
def q_report_row_audit(spark, sf):
    """Rows at every step of a run, counted by the write that the run needs anyway."""
    return _report("row_audit")(spark, sf)


_SLICE_NORMS = (
    "slice_key", "is_all", "tb", *KEYS, "days_on_stage_count", "days_on_stage_p20_days", "days_on_stage_p50_days",
    "days_on_stage_p80_days",
)


@query("q_slices_json", f"SELECT {', '.join(_SLICE_NORMS)} FROM sn")
def q_slices_json(spark, sf):
    """Norms of every slice as JSON by slice, one slice written again on its own, all read back."""
    path = f"{run_folder(spark)}/slices-{uuid.uuid4().hex}"
    records = materialise(slice_records(spark, sf))
    table = materialise(norms(records, clip_rules=UNIQUE_RULE, km=None, tags=["slice_key"]).select(*_SLICE_NORMS))
    manifest = slice_manifest(records, slice_catalog(spark, SWITCHES))
    one = F.col("slice_key") == "from_1998"
    # The first run has wrong days in the slice that the second one rewrites.
    wrong = F.when(one, F.lit(-1)).otherwise(F.col("days_on_stage_p80_days"))
    write_slices(table.withColumn("days_on_stage_p80_days", wrong.cast("long")), manifest, path)
    write_slices(table.filter(one), manifest.filter(one), path, mode="replace")
    return read_slices(spark, path, table.schema).select(*_SLICE_NORMS)


@query("q_stage_mode_substages", "SELECT * FROM er_sub")
def q_stage_mode_substages(spark, sf):
    """The mode under the name that settings use."""
    return lead_stage_records(event_reports(spark, sf), "substages")
