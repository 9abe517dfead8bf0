"""Queries for filters, slices and the funnel."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellspark.operators.filters import (
    apply_filters,
    config_only_filters,
    filter_subset,
    label_pool,
    latest_rows,
    ordered_filters,
    rank_pool,
    terminal_rows_out,
)
from dwellspark.operators.funnel import filter_catalog, funnel, group_funnel
from dwellspark.operators.quality import row_audit
from dwellspark.operators.slices import slice_catalog, slices
from dwellspark.plans.fixtures import event_reports, stage_reports, table
from dwellspark.plans.registry import cte, query
from dwellspark.plans.settings import FILTERS, KEYS, ORDER, STEPS_SQL


def _one(df, **description):
    return ordered_filters(df, {"only": {"enabled": True, **description}})


def _parts(spark, sf):
    return table(spark, sf, "part")


def _filter_query(name, condition, **description):
    @query(name, f"SELECT p_partkey, p_name, p_size FROM part WHERE {condition}")
    def run(spark, sf):
        return _one(_parts(spark, sf), **description).select("p_partkey", "p_name", "p_size")

    return run


_filter_query("q_filter_equals", "lower(p_name) = 'red widget'", column_key="p_name", values=[" RED widget "])
_filter_query(
    "q_filter_equals_case", "p_name = 'red widget' OR p_name = 'hot gear'", column_key="p_name",
    values=["red widget", "hot gear", "Blue bolt"], case_sensitive=True,
)
_filter_query("q_filter_contains", "p_name LIKE '%ring%'", column_key="p_name", contains="RING")
_filter_query("q_filter_prefix", "p_name LIKE 'small%'", column_key="p_name", values=["Small"], match="startswith")
_filter_query("q_filter_suffix", "p_name LIKE '%bolt'", column_key="p_name", values=["BOLT"], match="ends_with")
_filter_query("q_filter_number", "p_size > 10 AND p_size > 25", column_key="p_size", values=[10, "25"], match=">", values_mode="all", value_type="number")
_filter_query(
    "q_filter_all_values", "p_name LIKE '%s%' AND p_name LIKE '%gear%'", column_key="p_name",
    contains_all=["s", "Gear"],
)
_filter_query(
    "q_filter_any_values", "p_name LIKE '%widget%' OR p_name LIKE '%gizmo%'", column_key="p_name",
    contains_any=["widget", "gizmo"],
)
_filter_query(
    "q_filter_multi_column", "p_name LIKE '%small%' OR lower(p_type) LIKE '%small%'", column_key="p_name",
    column_keys=["p_type", "not_there"], values=["small"], match="contains",
)
_filter_query("q_filter_no_values", "true", column_key="p_name", values=[])


@query(
    "q_filter_number_text",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity <= 3 OR l_quantity = 40",
)
def q_filter_number_text(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("string"))
    low = _one(df, column_key="q", values=[3], match="lte", value_type="number")
    forty = _one(df, column_key="q", values=["40"], value_type="number")
    return low.unionByName(forty).select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "q_filter_date",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE cast(o_orderdate AS date) > DATE '1999-05-01'
       OR cast(o_orderdate AS date) > DATE '2000-01-31'""",
)
def q_filter_date(spark, sf):
    found = _one(
        table(spark, sf, "orders"), column_key="o_orderdate", values=["01.05.1999", "2000-01-31"], match="gt"
    )
    return found.select("o_orderkey", "o_orderdate")


@query(
    "q_filter_date_text",
    "SELECT o_orderkey FROM orders WHERE cast(o_orderdate AS date) <= DATE '1995-03-01'",
)
def q_filter_date_text(spark, sf):
    df = table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "dd.MM.yyyy"))
    return _one(df, column_key="day", values=["1995-03-01"], match="<=").select("o_orderkey")


@query("q_filter_max", "SELECT seq, report_date FROM er WHERE report_date = (SELECT max(report_date) FROM er)")
def q_filter_max(spark, sf):
    return _one(event_reports(spark, sf), column_key="report_date", match="max").select("seq", "report_date")


@query(
    "q_filter_min",
    "SELECT seq, days_on_stage FROM er WHERE days_on_stage = (SELECT min(days_on_stage) FROM er)",
)
def q_filter_min(spark, sf):
    return _one(event_reports(spark, sf), column_key="days_on_stage", match="min").select("seq", "days_on_stage")


@query(
    "q_filter_max_text",
    "SELECT seq, vks FROM er WHERE vks = (SELECT max(trim(vks)) FROM er)",
)
def q_filter_max_text(spark, sf):
    return _one(event_reports(spark, sf), column_key="vks", match="max").select("seq", "vks")


@query(
    "q_filter_exclude",
    "SELECT seq, deal_stage, vks FROM er WHERE NOT (deal_stage LIKE '%1' OR vks LIKE '%1')",
)
def q_filter_exclude(spark, sf):
    # A dash is an empty cell: no exclude filter drops it.
    found = _one(
        event_reports(spark, sf), column_key="deal_stage", also_column_keys=["vks"], action="exclude",
        values=["1", "-"], match="ends_with", value_type="string",
    )
    return found.select("seq", "deal_stage", "vks")


@query("q_apply_filters", "SELECT line_key FROM sr WHERE change_conditions = 0 AND efs_flag = 1 AND data_entry IN (0, 1)")
def q_apply_filters(spark, sf):
    return apply_filters(
        stage_reports(spark, sf, "line_key", "change_conditions", "efs_flag", "data_entry"), FILTERS
    ).select("line_key")


_EXTREME = {
    "efs_flag": {"enabled": True, "column_key": "efs_flag", "values": [1]},
    "not_click": {"enabled": True, "column_key": "current_status", "action": "exclude", "values": ["CLICK"]},
    "newest": {"enabled": True, "column_key": "report_date", "match": "max"},
    "longest": {"enabled": True, "column_key": "days_on_stage", "match": "max"},
    "off": {"enabled": False, "column_key": "current_status", "values": ["view"]},
}
_EXTREME_ORDER = ["not_click", "newest", "efs_flag", "longest", "unknown", "off"]

cte("ch1", "SELECT * FROM er WHERE lower(current_status) <> 'click'")
cte("ch2", "SELECT * FROM ch1 WHERE report_date = (SELECT max(report_date) FROM ch1)")
cte("ch3", "SELECT * FROM ch2 WHERE efs_flag = 1")
cte("ch4", "SELECT * FROM ch3 WHERE days_on_stage = (SELECT max(days_on_stage) FROM ch3)")


@query("q_ordered_filters", "SELECT seq, report_date, days_on_stage FROM ch4")
def q_ordered_filters(spark, sf):
    found = ordered_filters(event_reports(spark, sf), _EXTREME, _EXTREME_ORDER)
    return found.select("seq", "report_date", "days_on_stage")


@query(
    "q_funnel_extreme",
    " UNION ALL ".join(
        f"""SELECT cast({i} AS integer) AS step, '{n}' AS filter_name, a.n AS before_rows, b.n AS after_rows,
            a.n - b.n AS dropped_rows, a.l AS before_leads, b.l AS after_leads, a.l - b.l AS dropped_leads
            FROM (SELECT count(*) AS n, count(DISTINCT lead_id) AS l FROM {x}) a,
                 (SELECT count(*) AS n, count(DISTINCT lead_id) AS l FROM {y}) b"""
        for i, n, x, y in (
            (1, "not_click", "er", "ch1"), (2, "newest", "ch1", "ch2"), (3, "efs_flag", "ch2", "ch3"),
            (4, "longest", "ch3", "ch4"),
        )
    ),
)
def q_funnel_extreme(spark, sf):
    return funnel(event_reports(spark, sf), _EXTREME, _EXTREME_ORDER).drop("kind", "description")


@query(
    "q_terminal_rows",
    f"SELECT line_key, lead_id FROM sr WHERE {STEPS_SQL['no_unspecified']} AND {STEPS_SQL['no_returns']}",
)
def q_terminal_rows(spark, sf):
    df = stage_reports(spark, sf, "line_key", "lead_id", "deal_stage", "current_status")
    return terminal_rows_out(df, FILTERS).select("line_key", "lead_id")


@query("q_config_only", "SELECT line_key FROM sr WHERE change_conditions = 0 AND efs_flag = 1 AND data_entry IN (0, 1)")
def q_config_only(spark, sf):
    df = stage_reports(spark, sf, "line_key", "change_conditions", "efs_flag", "data_entry")
    return config_only_filters(df, FILTERS).select("line_key")


@query(
    "q_filter_subset",
    "SELECT line_key, label FROM sr WHERE label LIKE '%ring%' AND label LIKE '%e%' AND report_date >= DATE '1998-01-01'",
)
def q_filter_subset(spark, sf):
    df = stage_reports(spark, sf, "line_key", "label", "report_date", "deal_stage")
    return filter_subset(df, FILTERS, ["spring_parts", "from_1998", "no_unspecified"]).select("line_key", "label")


@query("q_latest_snapshot", "SELECT seq FROM er WHERE report_date = (SELECT max(report_date) FROM er)")
def q_latest_snapshot(spark, sf):
    return latest_rows(event_reports(spark, sf)).select("seq")


@query(
    "q_label_pool",
    """SELECT mode, count(*) AS report_rows FROM (
         SELECT p_partkey, unnest(CASE p_partkey % 3 WHEN 0 THEN ['all', 'strategy', 'strategy_2026']
            WHEN 1 THEN ['all', 'strategy'] ELSE ['all', 'non_strategy'] END) AS mode FROM part)
       GROUP BY mode""",
)
def q_label_pool(spark, sf):
    turn = F.col("p_partkey") % 3
    label = F.when(turn == 0, F.concat(F.lit("СТРАТЕГИЯ 2026 "), "p_name")).when(
        turn == 1, F.concat("p_name", F.lit(" стратегия"))
    )
    modes = ["all", "strategy", "strategy_2026", "non_strategy"]
    hits = F.array_compact(F.array(*[F.when(label_pool(label, m), F.lit(m)) for m in modes]))
    return (
        _parts(spark, sf).select(F.explode(hits).alias("mode")).groupBy("mode")
        .agg(F.count(F.lit(1)).alias("report_rows"))
    )


@query(
    "q_rank_selection",
    """SELECT line_key, product FROM sr WHERE product_group IN ('ECONOMY', 'SMALL') AND product IN ('Brand#1', 'Brand#2', 'Brand#3')
       AND label LIKE '%ring%' AND efs_flag = 1 AND change_conditions = 0""",
)
def q_rank_selection(spark, sf):
    df = stage_reports(
        spark, sf, "line_key", "product_group", "product", "label", "efs_flag", "change_conditions"
    )
    return rank_pool(
        df, ["ECONOMY", "SMALL"], ["Brand#1", "Brand#2", "Brand#3"], F.col("label").contains("ring"), 1, 0
    ).select("line_key", "product")


# --- slices -------------------------------------------------------------------

SWITCHES = {
    n: f for n, f in FILTERS.items() if n in ("even_lines", "no_unspecified", "red_parts", "spring_parts", "from_1998")
}
_SWITCH_SQL = {
    "red_parts": "label LIKE '%red%'",
    "spring_parts": "(label LIKE '%ring%' AND label LIKE '%e%')",
    "from_1998": "report_date >= DATE '1998-01-01'",
}
_COMBOS = [[], ["red_parts"], ["spring_parts"], ["from_1998"], ["red_parts", "from_1998"], ["spring_parts", "from_1998"]]
_FIXED = f"change_conditions = 0 AND {STEPS_SQL['no_unspecified']}"

cte(
    "sl",
    " UNION ALL ".join(
        f"SELECT *, '{'+'.join(sorted(c)) or 'none'}' AS slice_key FROM sr WHERE {_FIXED}"
        + "".join(f" AND {_SWITCH_SQL[n]}" for n in c)
        for c in _COMBOS
    ),
)


@query("q_filter_slices", "SELECT slice_key, line_key FROM sl")
def q_filter_slices(spark, sf):
    df = stage_reports(
        spark, sf, "line_key", "change_conditions", "label", "report_date", "deal_stage", "current_status"
    )
    return slices(df, SWITCHES).select("slice_key", "line_key")


@query(
    "q_slice_catalog",
    """SELECT slice_key, cast(CASE slice_key WHEN 'none' THEN 0 ELSE 1 + (slice_key LIKE '%+%')::int END AS integer) AS filter_count,
       slice_key = 'from_1998' AS is_default, count(*) AS report_rows FROM sl GROUP BY slice_key""",
)
def q_slice_catalog(spark, sf):
    counts = q_filter_slices(spark, sf).groupBy("slice_key").agg(F.count(F.lit(1)).alias("report_rows"))
    catalog = slice_catalog(spark, SWITCHES)
    return catalog.join(counts, "slice_key").select("slice_key", "filter_count", "is_default", "report_rows")


# --- funnel ---------------------------------------------------------------------

_REACHED = [
    " AND ".join(["true", *[STEPS_SQL[n] for n in ORDER[:i]]]) for i in range(len(ORDER) + 1)
]
FUNNEL_COLUMNS = (
    "seq", "lead_id", "tb", *KEYS, "change_conditions", "efs_flag", "data_entry", "deal_stage",
)

cte(
    "fu",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c}) AS r{i}, count(DISTINCT lead_id) FILTER (WHERE {c}) AS l{i}"
        for i, c in enumerate(_REACHED)
    )
    + " FROM sr",
)
FUNNEL_SQL = " UNION ALL ".join(
    f"""SELECT cast({i + 1} AS integer) AS step, '{n}' AS filter_name,
        '{FILTERS[n].get("description", n)}' AS description,
        '{"exclude" if FILTERS[n].get("action") == "exclude" else "filter"}' AS kind,
        r{i} AS before_rows, r{i + 1} AS after_rows, r{i} - r{i + 1} AS dropped_rows,
        l{i} AS before_leads, l{i + 1} AS after_leads, l{i} - l{i + 1} AS dropped_leads FROM fu"""
    for i, n in enumerate(ORDER)
)
cte("fun", FUNNEL_SQL)


@query("q_funnel", "SELECT * FROM fun")
def q_funnel(spark, sf):
    return funnel(stage_reports(spark, sf, *FUNNEL_COLUMNS), FILTERS, ORDER)


def _group_funnel_sql(tb, is_all):
    counts = [f"count(DISTINCT lead_id) FILTER (WHERE {c})" for c in _REACHED]
    drops = ", ".join(f"{counts[i]} - {counts[i + 1]} AS filter_dropped_{n}" for i, n in enumerate(ORDER))
    return f"""SELECT {is_all} AS is_all, {tb} AS tb, product_group, product, current_status,
        {counts[0]} AS filter_before, {drops}, {counts[-1]} AS filter_after FROM sr
        GROUP BY {"" if is_all == "true" else "tb, "}product_group, product, current_status"""


cte("gf", _group_funnel_sql("tb", "false") + " UNION ALL " + _group_funnel_sql("'все тб'", "true"))


@query("q_group_funnel", "SELECT * FROM gf")
def q_group_funnel(spark, sf):
    return group_funnel(stage_reports(spark, sf, *FUNNEL_COLUMNS), FILTERS, ORDER)


_CATALOG_ROWS = [
    ("even_lines", "yes", "include", "equals", "change_conditions", "0", "any", "number"),
    ("open_orders", "yes", "include", "gte", "efs_flag", "1", "any", "number"),
    ("no_unspecified", "yes", "exclude", "contains", "deal_stage", "4-not", "any", "string"),
    ("first_two_thirds", "yes", "include", "lt", "data_entry", "2", "any", "number"),
    ("no_returns", "yes", "exclude", "equals", "current_status", "ro", "any", "string"),
    ("from_1998", "no", "include", "gte", "report_date", "1998-01-01", "any", "date"),
    ("spring_parts", "no", "include", "contains", "label", "ring, e", "all", "string"),
    ("red_parts", "no", "include", "contains", "label", "Red", "any", "string"),
]
_CATALOG_SQL = " UNION ALL ".join(
    f"SELECT cast({i} AS integer) AS position, "
    + ", ".join(
        f"'{v}' AS {c}"
        for c, v in zip(
            ("filter_name", "enabled", "action", "match", "column_key", "filter_values", "values_mode", "value_type"),
            row,
        )
    )
    + f", '{FILTERS[row[0]].get('description', row[0])}' AS description"
    for i, row in enumerate(_CATALOG_ROWS, start=1)
)


@query(
    "q_filter_catalog",
    f"""SELECT c.*, before_rows, after_rows, dropped_rows, before_leads, after_leads, dropped_leads
        FROM ({_CATALOG_SQL}) c LEFT JOIN fun ON c.filter_name = fun.filter_name""",
)
def q_filter_catalog(spark, sf):
    return filter_catalog(stage_reports(spark, sf, *FUNNEL_COLUMNS), FILTERS, ORDER)


@query(
    "q_row_audit",
    """SELECT count(*) AS rows_before, count(*) FILTER (WHERE current_status = 'click') AS rows_after,
       count(*) FILTER (WHERE current_status <> 'click') AS dropped, 'status' AS reason FROM er""",
)
def q_row_audit(spark, sf):
    df = event_reports(spark, sf, "current_status")
    return row_audit(df, df.filter(F.col("current_status") == "click"), "status")
