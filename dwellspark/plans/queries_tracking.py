"""Queries for lead-stage records and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellspark.operators.pivots import attach_status_days, status_days, status_pivot
from dwellspark.operators.quality import lead_coverage, missing_days
from dwellspark.operators.slices import sliced_records
from dwellspark.operators.snapshot import FIELDS, lead_snapshot, snapshot_export
from dwellspark.operators.tracking import dedup_same_date, lead_stage_records, manager_records
from dwellspark.plans.fixtures import event_reports, stage_reports
from dwellspark.plans.queries_filters import SWITCHES
from dwellspark.plans.registry import cte, query

REST = ("deal_id", "inn", "client", "change_conditions", "efs_flag", "vks", "km", "label")


def daily_sql(src, level="status", group_only=False, rest=REST, tags=()):
    stage = "deal_stage" if level == "substage" else "current_status"
    keys = [*tags, "lead_id", "product_group", *([] if group_only else ["product"]), "tb", stage, "report_date"]
    fields = [c for c in ("current_status", "deal_stage", "product", *rest) if c not in keys]
    firsts = ", ".join(f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in fields)
    where = "WHERE deal_stage NOT IN ('-', 'nan', '')" if level == "substage" else ""
    return f"""SELECT {', '.join(keys)}, max(days_on_stage) AS days_on_stage, max(days_since_deal) AS days_since_deal,
        {firsts} FROM {src} {where} GROUP BY {', '.join(keys)}"""


def best_sql(daily, level="status", group_only=False, rest=REST, tags=()):
    stage = "deal_stage" if level == "substage" else "current_status"
    keys = [*tags, "lead_id", "product_group", *([] if group_only else ["product"]), "tb", stage]
    out = [*tags, "lead_id", "product_group", "tb", "current_status", "report_date", "days_on_stage", "days_since_deal", *rest]
    product = "'—' AS product" if group_only else "product"
    deal = "deal_stage" if level == "substage" else "'' AS deal_stage"
    return f"""SELECT {', '.join(out)}, {product}, {deal}, '{level}' AS analysis_level, {stage} AS stage_key
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)}
              ORDER BY days_on_stage DESC NULLS LAST, report_date DESC NULLS LAST) AS rn FROM {daily}) WHERE rn = 1"""


cte("er_day", daily_sql("er"))
cte("er_rec", best_sql("er_day"))
cte("er_sub_day", daily_sql("er", "substage"))
cte("er_sub", best_sql("er_sub_day", "substage"))
cte("er_grp_day", daily_sql("er", group_only=True))
cte("er_grp", best_sql("er_grp_day", group_only=True))
cte("sr_day", daily_sql("sr"))
cte("sr_rec", best_sql("sr_day"))


@query("q_dedup_same_date", "SELECT * FROM er_day")
def q_dedup_same_date(spark, sf):
    return dedup_same_date(event_reports(spark, sf))


@query("q_lead_stage_records", "SELECT * FROM er_rec")
def q_lead_stage_records(spark, sf):
    return lead_stage_records(event_reports(spark, sf))


@query("q_stage_records_lines", "SELECT * FROM sr_rec")
def q_stage_records_lines(spark, sf):
    return lead_stage_records(stage_reports(spark, sf))


@query("q_substage_records", "SELECT * FROM er_sub")
def q_substage_records(spark, sf):
    return lead_stage_records(event_reports(spark, sf), "substage")


@query("q_both_levels", "SELECT * FROM er_rec UNION ALL BY NAME SELECT * FROM er_sub")
def q_both_levels(spark, sf):
    return lead_stage_records(event_reports(spark, sf), "both")


@query("q_group_only", "SELECT * FROM er_grp")
def q_group_only(spark, sf):
    return lead_stage_records(event_reports(spark, sf), product_mode="group_only")


_SLIM = ("deal_id", "km")
cte("sl_day", daily_sql("sl", rest=_SLIM, tags=("slice_key",)))
cte("sl_rec", best_sql("sl_day", rest=_SLIM, tags=("slice_key",)))


def slice_records(spark, sf):
    """One record per slice, lead and stage."""
    df = stage_reports(
        spark, sf, "seq", "lead_id", "product_group", "product", "tb", "current_status", "deal_stage",
        "report_date", "days_on_stage", "days_since_deal", "label", "change_conditions", "deal_id", "km",
    )
    return sliced_records(df, SWITCHES).drop("label", "change_conditions")


@query("q_slice_records", "SELECT * FROM sl_rec")
def q_slice_records(spark, sf):
    return slice_records(spark, sf)


cte("ml", "SELECT * FROM er WHERE report_date = (SELECT max(report_date) FROM er)")
cte("ml_day", daily_sql("ml"))
cte("ml_rec", best_sql("ml_day"))


@query("q_manager_records", "SELECT * FROM ml_rec")
def q_manager_records(spark, sf):
    return manager_records(event_reports(spark, sf))


# --- snapshot -------------------------------------------------------------------

_ORDER = "row(DATE '2100-01-01' - report_date, seq)"
_SNAP_FIELDS = [f for f in FIELDS if f not in ("client_id", "gosb", "sales_method", "client")]


def snapshot_sql(src, fields=tuple(_SNAP_FIELDS), more=""):
    picks = ", ".join(
        f"arg_min({f}, {_ORDER}) FILTER (WHERE {f} IS NOT NULL AND lower(trim(cast({f} AS varchar))) NOT IN ('', '-', 'nan', 'none', 'null', 'nat')) AS {f}"
        for f in fields
    )
    return f"""SELECT lead_id, max(report_date) AS report_date, arg_min_null(days_on_stage, {_ORDER}) AS days_on_stage,
        {picks} {more} FROM {src} WHERE trim(lead_id) <> '' GROUP BY lead_id"""


cte(
    "er_snap",
    snapshot_sql(
        "er",
        more=f""", arg_min_null(sales_method, {_ORDER}) AS sales_method,
        'ООО "C' || lead_id || '"' AS client""",
    ),
)
cte("sr_snap", snapshot_sql("sr", more=f", arg_min_null(sales_method, {_ORDER}) AS sales_method, any_value(client) AS client"))


@query("q_lead_snapshot", "SELECT * FROM er_snap")
def q_lead_snapshot(spark, sf):
    return lead_snapshot(event_reports(spark, sf))


@query("q_lead_snapshot_lines", "SELECT * FROM sr_snap")
def q_lead_snapshot_lines(spark, sf):
    return lead_snapshot(stage_reports(spark, sf))


@query("q_snapshot_latest_only", "SELECT lead_id, sales_method, report_date FROM er_snap")
def q_snapshot_latest_only(spark, sf):
    df = event_reports(spark, sf, "lead_id", "report_date", "days_on_stage", "sales_method", "seq")
    return lead_snapshot(df).select("lead_id", "sales_method", "report_date")


_STATUSES = ("View", "CLICK", "purchase")


def _status_sql(names):
    return ", ".join(
        f"cast(round_even(max(days_on_stage) FILTER (WHERE lower(current_status) = '{n.lower()}'), 0) AS bigint) AS \"{n}\""
        for n in names
    )


@query(
    "q_status_pivot",
    f"""SELECT lead_id, {_status_sql(_STATUSES)} FROM er_rec WHERE days_on_stage IS NOT NULL GROUP BY lead_id""",
)
def q_status_pivot(spark, sf):
    return status_pivot(lead_stage_records(event_reports(spark, sf)), _STATUSES)


@query(
    "q_status_days",
    """SELECT lead_id, current_status AS status, max(days_on_stage) AS days
       FROM er_rec WHERE days_on_stage IS NOT NULL GROUP BY lead_id, current_status""",
)
def q_status_days(spark, sf):
    """Statuses of the data, known beforehand or not, in long form."""
    return status_days(lead_stage_records(event_reports(spark, sf)), ())


@query(
    "q_status_pivot_found",
    """SELECT lead_id, cast(round_even(max(days_on_stage) FILTER (WHERE current_status = 'click'), 0) AS bigint) AS "click",
       cast(round_even(max(days_on_stage), 0) AS bigint) AS longest
       FROM er_rec WHERE days_on_stage IS NOT NULL GROUP BY lead_id""",
)
def q_status_pivot_found(spark, sf):
    records = lead_stage_records(event_reports(spark, sf))
    longest = status_days(records, ()).groupBy("lead_id").agg(F.bround(F.max("days")).cast("long").alias("longest"))
    return longest.join(status_pivot(records, (), ("click",)), "lead_id").select("lead_id", "click", "longest")


cte(
    "er_attach",
    f"""SELECT s.*, p.* EXCLUDE (lead_id) FROM er_snap s LEFT JOIN
        (SELECT lead_id, {_status_sql(_STATUSES)} FROM er_rec WHERE days_on_stage IS NOT NULL GROUP BY lead_id) p
        ON s.lead_id = p.lead_id""",
)


@query("q_status_days_attach", "SELECT * FROM er_attach")
def q_status_days_attach(spark, sf):
    df = event_reports(spark, sf)
    return attach_status_days(lead_snapshot(df), status_pivot(lead_stage_records(df), _STATUSES))


@query(
    "q_snapshot_export",
    """SELECT lead_id AS "ID", product_group, product, current_status AS "Stage", "View", "CLICK", "purchase", inn, client,
       work_start_date, deal_id, deal_created_date, sales_method, deal_stage, tb, km, vks FROM er_attach""",
)
def q_snapshot_export(spark, sf):
    wide = q_status_days_attach(spark, sf)
    return snapshot_export(wide, status_columns=_STATUSES, labels={"lead_id": "ID", "current_status": "Stage"})


@query(
    "q_lead_coverage",
    """SELECT DISTINCT lead_id, 'missing' AS side FROM sr WHERE lead_id NOT IN
       (SELECT lead_id FROM sr WHERE efs_flag = 1 AND change_conditions = 0)""",
)
def q_lead_coverage(spark, sf):
    df = stage_reports(spark, sf, "lead_id", "efs_flag", "change_conditions")
    return lead_coverage(df, df.filter("efs_flag = 1 and change_conditions = 0"))


@query(
    "q_missing_days",
    "SELECT count(*) AS records, count(*) FILTER (WHERE days_on_stage IS NULL) AS without_days FROM er_rec",
)
def q_missing_days(spark, sf):
    return missing_days(lead_stage_records(event_reports(spark, sf)))
