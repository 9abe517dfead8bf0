"""Queries for percentiles, clipping, norms and exceedances."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellspark.operators.clipping import clip
from dwellspark.operators.distinct import distinct_rollup
from dwellspark.operators.exceedance import exceedance, exceedance_detail, exceedances, lead_records
from dwellspark.operators.filters import ordered_filters
from dwellspark.operators.funnel import audit_summary, group_funnel, norms_with_funnel
from dwellspark.operators.histogram import day_histogram, percentile_stats
from dwellspark.operators.norms import (
    norms,
    norms_export,
    one_territory,
    statistic,
    stats_by_group,
    stats_nested,
    stats_variant,
    with_overall,
)
from dwellspark.operators.slices import slice_catalog
from dwellspark.operators.snapshot import lead_snapshot
from dwellspark.operators.tracking import lead_stage_records, manager_records
from dwellspark.plans.fixtures import event_reports, stage_reports
from dwellspark.plans.queries_filters import FUNNEL_COLUMNS, SWITCHES
from dwellspark.plans.queries_tracking import best_sql, daily_sql, slice_records
from dwellspark.plans.registry import cte, query
from dwellspark.plans.settings import CLIP_RULES, FILTERS, KEYS, METRICS, ORDER, STEPS_SQL, UNIQUE_RULE
from dwellspark.session import materialise
from dwellspark.sources.sinks import slice_manifest

PERCENTILES = (20, 50, 80)


def stats_sql(src, group, prefix="days_on_stage", d="d", km=None, percentiles=PERCENTILES):
    """Statistics of raw rows; `d` is the whole day."""
    keys = ", ".join(group)
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM q.{k}" for k in group)
    qs = ", ".join(f"quantile_disc({d}, {p / 100}) AS p{p}" for p in percentiles)
    parts = [f"q.{k}" for k in group]
    parts += [
        f"min(mn) AS {prefix}_min",
        f"min(mx) AS {prefix}_max",
        f"min(n) AS {prefix}_count",
        f"count(*) FILTER (WHERE {d} <= mn) AS {prefix}_min_le_count",
        f"count(*) FILTER (WHERE {d} > mn) AS {prefix}_min_gt_count",
        f"min(n) AS {prefix}_max_le_count",
        f"cast(0 AS bigint) AS {prefix}_max_gt_count",
    ]
    for p in percentiles:
        parts += [
            f"min(p{p}) AS {prefix}_p{p}_days",
            f"cast(CASE WHEN min(n) = 0 THEN 0 ELSE greatest(1, ceil(cast({p / 100} AS double) * min(n))) END AS bigint) AS {prefix}_p{p}_count",
            f"min(mn) AS {prefix}_p{p}_min",
            f"min(p{p}) AS {prefix}_p{p}_max",
            f"count(*) FILTER (WHERE {d} <= p{p}) AS {prefix}_p{p}_le_count",
            f"count(*) FILTER (WHERE {d} > p{p}) AS {prefix}_p{p}_gt_count",
        ]
    if km:
        parts.append(
            f"count(DISTINCT {km}) FILTER (WHERE {d} >= p80 AND lower(trim({km})) NOT IN ('', '-', 'nan', 'none')) AS {prefix}_p80_km_count"
        )
    return f"""SELECT {', '.join(parts)} FROM {src} s JOIN
        (SELECT {keys}, min({d}) AS mn, max({d}) AS mx, count({d}) AS n, {qs} FROM {src} GROUP BY {keys}) q ON {on}
        GROUP BY {', '.join('q.' + k for k in group)}"""


def both_scopes(src):
    return f"""SELECT false AS is_all, *, cast(round_even(days_on_stage, 0) AS bigint) AS d,
            cast(round_even(days_since_deal, 0) AS bigint) AS d2, true AS k FROM {src}
        UNION ALL BY NAME SELECT true AS is_all, * REPLACE ('все тб' AS tb), cast(round_even(days_on_stage, 0) AS bigint) AS d,
            cast(round_even(days_since_deal, 0) AS bigint) AS d2, true AS k FROM {src}"""


GROUP = ("is_all", "tb", *KEYS)


def clip_sql(src, rule, name, group=GROUP, min_size=5, min_remaining=3):
    """One rule over raw rows with `d` (whole day) and `k` (still kept)."""
    w = "PARTITION BY " + ", ".join(group)
    mode = rule["mode"]
    extra, cond = "", "false"
    low, high = rule.get("trim_lower_pct", 0), rule.get("trim_upper_pct", 0)
    if mode == "range":
        cond = f"(d < {rule['min_days']} OR d > {rule['max_days']})"
    elif mode == "percentile_trim":
        extra = f""", quantile_cont(d, {low / 100}) FILTER (WHERE k) OVER (w) AS lo_t,
            quantile_cont(d, {(100 - high) / 100}) FILTER (WHERE k) OVER (w) AS hi_t"""
        cond = f"leads >= {max(min_size, 3)} AND (d < lo_t OR d > hi_t)"
    elif mode == "unique_days_trim":
        extra = """, count(DISTINCT d) FILTER (WHERE k) OVER (w) AS u,
            dense_rank() OVER (w2 ORDER BY d) AS dr"""
        lo_n, hi_n = f"floor(u * {low} / 100)", f"floor(u * {high} / 100)"
        cond = f"leads >= {max(min_size, 3)} AND u >= 2 AND {lo_n} + {hi_n} < u AND (dr <= {lo_n} OR dr > u - {hi_n})"
    elif mode == "iqr":
        extra = """, quantile_cont(d, 0.25) FILTER (WHERE k) OVER (w) AS q1, quantile_cont(d, 0.75) FILTER (WHERE k) OVER (w) AS q3"""
        cond = f"leads >= {max(min_size, 4)} AND q3 > q1 AND (d < q1 - (q3 - q1) * 1.5 OR d > q3 + (q3 - q1) * 1.5)"
    scope = rule.get("scope", {}).get("product_group")
    if scope:
        cond += " AND lower(product_group) IN (" + ", ".join(f"'{s.lower()}'" for s in scope) + ")"
    extra = extra.replace("(w)", f"({w})").replace("(w2 ", f"({w}, k AND d IS NOT NULL ")
    return f"""SELECT * EXCLUDE (k, leads, live, dropped, cut), k AND NOT (cut > 0 AND live - cut >= {min_remaining} AND dropped) AS k,
          CASE WHEN cut > 0 AND live - cut >= {min_remaining} THEN cut ELSE 0 END AS outlier_rule_{name}
        FROM (SELECT *, count(*) FILTER (WHERE dropped) OVER ({w}) AS cut FROM
          (SELECT *, k AND d IS NOT NULL AND ({cond}) AS dropped FROM
            (SELECT *, count(*) FILTER (WHERE k AND d IS NOT NULL) OVER ({w}) AS leads,
               count(*) FILTER (WHERE k) OVER ({w}) AS live {extra} FROM {src})))"""


# --- statistics -------------------------------------------------------------------

cte("er_d", "SELECT *, cast(round_even(days_on_stage, 0) AS bigint) AS d FROM er_rec")
cte("er_stats", stats_sql("er_d", KEYS))


@query("q_day_histogram", "SELECT product_group, product, current_status, d AS day, count(*) AS cnt FROM er_d GROUP BY ALL")
def q_day_histogram(spark, sf):
    return day_histogram(lead_stage_records(event_reports(spark, sf)), KEYS)


@query(
    "q_empirical_percentiles",
    "SELECT current_status, days_on_stage_p20_days, days_on_stage_p50_days, days_on_stage_p80_days, days_on_stage_p80_count, "
    "days_on_stage_p80_le_count, days_on_stage_p80_gt_count FROM er_stats",
)
def q_empirical_percentiles(spark, sf):
    hist = day_histogram(lead_stage_records(event_reports(spark, sf)), KEYS)
    p = "days_on_stage_p80"
    return percentile_stats(hist, KEYS).select(
        "current_status", "days_on_stage_p20_days", "days_on_stage_p50_days", f"{p}_days", f"{p}_count",
        f"{p}_le_count", f"{p}_gt_count",
    )


@query("q_metric_stats", "SELECT * FROM er_stats")
def q_metric_stats(spark, sf):
    return percentile_stats(day_histogram(lead_stage_records(event_reports(spark, sf)), KEYS), KEYS)


# --- records of the report run ------------------------------------------------------

_RUN_REST = ("km",)
cte("rf", "SELECT * FROM sr WHERE " + " AND ".join(STEPS_SQL[n] for n in ORDER))
cte("rf_day", daily_sql("rf", rest=_RUN_REST))
cte("rf_rec", best_sql("rf_day", rest=_RUN_REST))
cte("rs", both_scopes("rf_rec"))
cte("ao", both_scopes("sr_rec"))

RUN_COLUMNS = (
    "seq", "lead_id", "report_date", "product_group", "product", "tb", "current_status", "deal_stage",
    "days_on_stage", "days_since_deal", "change_conditions", "efs_flag", "data_entry", "km",
)


def run_records(spark, sf):
    """Filtered reports, one record per lead and stage."""
    rows = ordered_filters(stage_reports(spark, sf, *RUN_COLUMNS), FILTERS, ORDER)
    return lead_stage_records(rows.drop("change_conditions", "efs_flag", "data_entry"))


def all_records(spark, sf, km=True):
    """Records of all reports, nothing filtered; without their managers, where nothing is said of them."""
    unused = ("change_conditions", "efs_flag", "data_entry", *([] if km else ["km"]))
    columns = [c for c in RUN_COLUMNS if c not in unused]
    return lead_stage_records(stage_reports(spark, sf, *columns))


cte("sr_d", "SELECT *, cast(round_even(days_on_stage, 0) AS bigint) AS d, cast(round_even(days_since_deal, 0) AS bigint) AS d2 FROM sr_rec")
cte("st1", stats_sql("sr_d", ("product_group", "product", "analysis_level", "stage_key"), km="km"))
cte("st2", stats_sql("sr_d", ("product_group", "product", "analysis_level", "stage_key"), "days_since_deal", "d2", km="km"))


@query("q_stats_by_group", "SELECT st1.*, st2.* EXCLUDE (product_group, product, analysis_level, stage_key) FROM st1 JOIN st2 USING (product_group, product, analysis_level, stage_key)")
def q_stats_by_group(spark, sf):
    keys = ["product_group", "product", "analysis_level", "stage_key"]
    return stats_by_group(all_records(spark, sf), keys, metrics=METRICS)


@query(
    "q_km_at_p80",
    "SELECT product_group, product, stage_key, days_on_stage_p80_days, days_on_stage_p80_km_count FROM st1",
)
def q_km_at_p80(spark, sf):
    table = stats_by_group(all_records(spark, sf), ["product_group", "product", "stage_key"])
    return table.select(
        "product_group", "product", "stage_key", "days_on_stage_p80_days", "days_on_stage_p80_km_count"
    )


cte("ao1", stats_sql("ao", GROUP, km="km"))
cte("ao2", stats_sql("ao", GROUP, "days_since_deal", "d2", km="km"))
cte("aon", f"SELECT ao1.*, ao2.* EXCLUDE ({', '.join(GROUP)}) FROM ao1 JOIN ao2 USING ({', '.join(GROUP)})")


def all_norms(spark, sf):
    return norms(all_records(spark, sf), metrics=METRICS)


@query("q_stats_grouping_sets", "SELECT * FROM aon")
def q_stats_grouping_sets(spark, sf):
    return all_norms(spark, sf)


@query("q_stats_one_tb", "SELECT * EXCLUDE (is_all, tb) FROM aon WHERE NOT is_all AND tb = 'ASIA'")
def q_stats_one_tb(spark, sf):
    return one_territory(all_norms(spark, sf), "ASIA")


def _clip_query(name, rule):
    cte(name + "_c", clip_sql("ao", rule, "only"))

    @query(
        f"q_clip_{name}",
        f"""SELECT is_all, tb, product_group, product, current_status, d AS day, count(*) AS cnt, k AS kept,
            outlier_rule_only FROM {name}_c GROUP BY ALL""",
    )
    def run(spark, sf):
        hist = day_histogram(all_records(spark, sf), ["tb", *KEYS])
        both = with_overall(hist).groupBy(*GROUP, "day").agg(F.sum("cnt").alias("cnt"))
        out = clip(both, GROUP, [{**rule, "name": "only"}])
        return out.select(*GROUP, "day", "cnt", "kept", "outlier_rule_only")

    return run


_clip_query("range", {"mode": "range", "min_days": 4, "max_days": 45})
_clip_query("percentile", {"mode": "percentile_trim", "trim_lower_pct": 5, "trim_upper_pct": 10})
_clip_query("unique_days", {"mode": "unique_days_trim", "trim_lower_pct": 10, "trim_upper_pct": 10})


cte(
    "lo",
    """SELECT false AS is_all, product_group, product, current_status, true AS k,
       CASE WHEN l % 50 = 0 THEN cast(round_even(days_on_stage * 10, 0) AS bigint) ELSE cast(round_even(days_on_stage, 0) AS bigint) END AS d
       FROM (SELECT *, cast(lead_id AS bigint) AS l FROM sr_rec)""",
)
cte("iqr_c", clip_sql("lo", {"mode": "iqr"}, "only", ("is_all", *KEYS)))


@query(
    "q_clip_iqr",
    "SELECT is_all, product_group, product, current_status, d AS day, count(*) AS cnt, k AS kept, outlier_rule_only FROM iqr_c GROUP BY ALL",
)
def q_clip_iqr(spark, sf):
    hist = day_histogram(_long_stays(spark, sf), ["is_all", *KEYS])
    out = clip(hist, ["is_all", *KEYS], [{"mode": "iqr", "name": "only"}])
    return out.select("is_all", *KEYS, "day", "cnt", "kept", "outlier_rule_only")


def _long_stays(spark, sf):
    """Records in which some stays are ten times as long."""
    days = F.when(F.col("lead_id").cast("long") % 50 == 0, F.col("days_on_stage") * 10).otherwise(F.col("days_on_stage"))
    return all_records(spark, sf).withColumns({"days_on_stage": days, "is_all": F.lit(False)})


cte("cl1", clip_sql("rs", CLIP_RULES[0], "range"))
cte("cl2", clip_sql("cl1", CLIP_RULES[2], "trim"))
cte("cl3", clip_sql("cl2", CLIP_RULES[3], "unique"))
cte("clk", "SELECT * FROM cl3 WHERE k")
cte(
    "cla",
    f"""SELECT {', '.join(GROUP)}, count(*) AS outlier_before, count(*) FILTER (WHERE k) AS outlier_after,
        count(*) FILTER (WHERE NOT k) AS outlier_clipped_total, min(outlier_rule_range) AS outlier_rule_range,
        min(outlier_rule_trim) AS outlier_rule_trim, min(outlier_rule_unique) AS outlier_rule_unique
        FROM cl3 GROUP BY {', '.join(GROUP)}""",
)
cte("no1", stats_sql("clk", GROUP, km="km"))
cte("no2", stats_sql("clk", GROUP, "days_since_deal", "d2", km="km"))
cte("nor", f"SELECT no1.*, cla.* EXCLUDE ({', '.join(GROUP)}) FROM no1 JOIN cla USING ({', '.join(GROUP)})")


@query("q_clip_rules_audit", "SELECT * FROM cla")
def q_clip_rules_audit(spark, sf):
    table = norms(run_records(spark, sf), clip_rules=CLIP_RULES, km=None)
    return table.select(*GROUP, *[c for c in table.columns if c.startswith("outlier_")])


def run_norms(spark, sf, **options):
    return norms(run_records(spark, sf), clip_rules=CLIP_RULES, **options)


@query("q_norms", "SELECT * FROM nor")
def q_norms(spark, sf):
    return run_norms(spark, sf)


@query("q_norms_two_metrics", f"SELECT nor.*, no2.* EXCLUDE ({', '.join(GROUP)}) FROM nor JOIN no2 USING ({', '.join(GROUP)})")
def q_norms_two_metrics(spark, sf):
    return run_norms(spark, sf, metrics=METRICS)


cte(
    "nof",
    f"""SELECT nor.*, gf.* EXCLUDE ({', '.join(GROUP)}) FROM nor JOIN gf USING ({', '.join(GROUP)})""",
)


def run_norms_audited(spark, sf):
    audit = group_funnel(stage_reports(spark, sf, *FUNNEL_COLUMNS), FILTERS, ORDER)
    return norms_with_funnel(run_norms(spark, sf), audit)


@query("q_norms_with_funnel", "SELECT * FROM nof")
def q_norms_with_funnel(spark, sf):
    return run_norms_audited(spark, sf)


_AUDITED = [
    "outlier_before", "outlier_after", "outlier_clipped_total", "outlier_rule_range", "outlier_rule_trim",
    "outlier_rule_unique", "filter_before", *[f"filter_dropped_{n}" for n in ORDER], "filter_after",
]


@query(
    "q_audit_summary",
    "SELECT 'groups' AS indicator, count(*) AS total FROM nof"
    + "".join(f" UNION ALL SELECT '{c}', cast(sum({c}) AS bigint) FROM nof" for c in _AUDITED),
)
def q_audit_summary(spark, sf):
    return audit_summary(run_norms_audited(spark, sf))


@query(
    "q_norms_export",
    """SELECT tb AS "Territory", product_group, product, current_status, days_on_stage_min, days_on_stage_max,
       days_on_stage_count AS "Leads", days_on_stage_p20_days, days_on_stage_p50_days, days_on_stage_p80_le_count,
       days_on_stage_p80_days AS "P80", days_on_stage_p80_gt_count, days_on_stage_p80_km_count,
       filter_before, """
    + ", ".join(f"filter_dropped_{n}" for n in ORDER)
    + """, filter_after, outlier_before, outlier_after, outlier_clipped_total, outlier_rule_range, outlier_rule_trim,
       outlier_rule_unique FROM nof""",
)
def q_norms_export(spark, sf):
    return norms_export(
        run_norms_audited(spark, sf),
        profiles={80.0: {"days", "le_count", "gt_count", "km_count"}},
        labels={"tb": "Territory", "days_on_stage_count": "Leads", "days_on_stage_p80_days": "P80"},
    )


@query(
    "q_stats_nested",
    """SELECT tb, product_group, product, current_status, days_on_stage_min AS min_days, days_on_stage_p50_days AS p50_days,
       days_on_stage_p80_gt_count AS p80_gt FROM no1""",
)
def q_stats_nested(spark, sf):
    nested = stats_nested(run_norms(spark, sf), ["tb", *KEYS])
    m = "metrics.days_on_stage"
    return nested.select(
        "tb", *KEYS, F.col(f"{m}.min").alias("min_days"), F.col(f"{m}.percentiles.p50.days").alias("p50_days"),
        F.col(f"{m}.percentiles.p80.gt_count").alias("p80_gt"),
    )


@query(
    "q_stats_variant",
    """SELECT tb, product_group, product, current_status, days_on_stage_min AS min_days, days_on_stage_p50_days AS p50_days,
       days_on_stage_p80_gt_count AS p80_gt, CAST(NULL AS bigint) AS p95_days FROM no1""",
)
def q_stats_variant(spark, sf):
    """Statistics as one variant column, written and read back; single percentiles by their path."""
    held = materialise(stats_variant(run_norms(spark, sf), ["tb", *KEYS]))
    return held.select(
        "tb", *KEYS, statistic("days_on_stage", "min").alias("min_days"),
        statistic("days_on_stage", "days", 50).alias("p50_days"), statistic("days_on_stage", "gt_count", 80).alias("p80_gt"),
        statistic("days_on_stage", "days", 95).alias("p95_days"),
    )


_LEVELS = (("tb", *KEYS), ("tb", "product_group"), ("tb",), ("product_group",), ())


@query(
    "q_distinct_rollup",
    " UNION ALL ".join(
        f"""SELECT {i} AS level, {', '.join(k if k in level else f'CAST(NULL AS varchar) AS {k}' for k in ('tb', *KEYS))},
            count(DISTINCT lead_id) AS n_lead_id, count(DISTINCT CASE WHEN km <> 'Supplier#000000001' THEN km END) AS n_km
            FROM sr {('GROUP BY ' + ', '.join(level)) if level else ''}"""
        for i, level in enumerate(_LEVELS)
    ),
)
def q_distinct_rollup(spark, sf):
    """Distinct leads and managers on five levels from bitmaps that are made once."""
    rows = stage_reports(spark, sf, "tb", *KEYS, "lead_id", "km")
    some = rows.withColumn("km", F.when(F.col("km") != "Supplier#000000001", F.col("km")))
    return distinct_rollup(some, _LEVELS, ["lead_id", "km"])


SLICE_GROUP = ("is_all", "tb", "slice_key", *KEYS)
cte("ss", both_scopes("sl_rec"))
cte("sc1", clip_sql("ss", UNIQUE_RULE[0], "unique", SLICE_GROUP))
cte("sck", "SELECT * FROM sc1 WHERE k")
cte("sn", stats_sql("sck", SLICE_GROUP))


@query(
    "q_slice_norms",
    "SELECT slice_key, is_all, tb, product_group, product, current_status, days_on_stage_count, days_on_stage_p20_days, "
    "days_on_stage_p50_days, days_on_stage_p80_days FROM sn",
)
def q_slice_norms(spark, sf):
    table = norms(slice_records(spark, sf), clip_rules=UNIQUE_RULE, km=None, tags=["slice_key"])
    return table.select(
        "slice_key", "is_all", "tb", *KEYS, "days_on_stage_count", "days_on_stage_p20_days",
        "days_on_stage_p50_days", "days_on_stage_p80_days",
    )


@query(
    "q_slice_manifest",
    """SELECT slice_key, cast(CASE slice_key WHEN 'none' THEN 0 ELSE 1 + (slice_key LIKE '%+%')::int END AS integer) AS filter_count,
       CASE slice_key WHEN 'none' THEN '' ELSE replace(slice_key, '+', ' + ') END AS active_filters,
       slice_key = 'from_1998' AS is_default, count(*) AS record_count FROM sl_rec GROUP BY slice_key""",
)
def q_slice_manifest(spark, sf):
    return slice_manifest(slice_records(spark, sf), slice_catalog(spark, SWITCHES))


# --- exceedance -----------------------------------------------------------------------

cte("rf_snap", """SELECT lead_id, max(report_date) AS report_date,
       arg_min_null(days_on_stage, row(DATE '2100-01-01' - report_date, seq)) AS days_on_stage, """
    + ", ".join(
        f"arg_min({f}, row(DATE '2100-01-01' - report_date, seq)) FILTER (WHERE {f} IS NOT NULL) AS {f}"
        for f in ("product_group", "product", "current_status", "tb", "deal_id", "km", "vks", "client")
    )
    + " FROM rf GROUP BY lead_id")
cte(
    "ex",
    """SELECT s.*, coalesce(t.days_on_stage_p80_days, a.days_on_stage_p80_days) AS norm_days,
       round_even(s.days_on_stage, 0) AS current_days,
       coalesce(round_even(s.days_on_stage, 0) > coalesce(t.days_on_stage_p80_days, a.days_on_stage_p80_days), false) AS exceeded
       FROM rf_snap s
       LEFT JOIN (SELECT * FROM no1 WHERE NOT is_all) t ON s.tb = t.tb AND s.product_group = t.product_group
         AND s.product = t.product AND s.current_status = t.current_status
       LEFT JOIN (SELECT * FROM no1 WHERE is_all) a ON s.product_group = a.product_group
         AND s.product = a.product AND s.current_status = a.current_status""",
)
EXCEED_COLUMNS = ("deal_id", "vks", "client")


def run_snapshot(spark, sf):
    rows = ordered_filters(stage_reports(spark, sf, *RUN_COLUMNS, *EXCEED_COLUMNS), FILTERS, ORDER)
    return lead_snapshot(rows).drop("deal_stage")


def run_exceedance(spark, sf):
    """Snapshot against the norms; the norms are written once and their size is checked."""
    table = materialise(run_norms(spark, sf, km=None))
    return exceedance(run_snapshot(spark, sf), table)


@query(
    "q_exceedance",
    """SELECT *, CASE WHEN exceeded THEN 'ДА' END AS exceeded_flag,
       CASE WHEN exceeded THEN current_days - norm_days END AS exceeded_days FROM ex""",
)
def q_exceedance(spark, sf):
    return run_exceedance(spark, sf)


cte("ov", stats_sql("er_d", ("product_group", "product", "stage_key", "analysis_level")))
cte(
    "ed",
    """SELECT m.tb, m.km, m.product_group, m.product, m.stage_key, m.analysis_level, m.lead_id, m.days_on_stage AS days_int,
       t.days_on_stage_p80_days AS threshold_days, coalesce(m.days_on_stage > t.days_on_stage_p80_days, false) AS exceeded,
       m.label, m.deal_id, m.inn, m.client, m.change_conditions, m.efs_flag, m.vks
       FROM ml_rec m LEFT JOIN ov t ON m.product_group = t.product_group AND m.product = t.product
         AND m.stage_key = t.stage_key AND m.analysis_level = t.analysis_level""",
)


def event_detail(spark, sf):
    """Records of the newest date against the norms of all dates."""
    df = event_reports(spark, sf)
    keys = ["product_group", "product", "stage_key", "analysis_level"]
    table = norms(lead_stage_records(df), keys, km=None)
    return exceedance_detail(manager_records(df), table, keys=keys)


@query("q_exceed_detail", "SELECT * FROM ed")
def q_exceed_detail(spark, sf):
    return event_detail(spark, sf)


_MASK = """tb, km, product_group, product, stage_key, analysis_level, lead_id, round_even(days_int, 1) AS days_int,
    round_even(cast(threshold_days AS double), 1) AS threshold_days, exceeded, label,
    CASE WHEN exceeded THEN deal_id END AS deal_id, CASE WHEN exceeded THEN inn END AS inn,
    CASE WHEN exceeded THEN 'ООО "C' || lead_id || '"' END AS client, change_conditions, efs_flag,
    CASE WHEN exceeded AND vks <> '-' THEN vks END AS vks, coalesce(tb, '') || '|' || coalesce(km, '') AS km_tb_key"""


@query("q_lead_records_masked", f"SELECT {_MASK} FROM ed")
def q_lead_records_masked(spark, sf):
    return lead_records(event_detail(spark, sf))


@query("q_exceedances", f"SELECT {_MASK}, round_even(greatest(round_even(days_int, 1) - threshold_days, 0), 1) AS overshoot FROM ed WHERE exceeded")
def q_exceedances(spark, sf):
    return exceedances(event_detail(spark, sf))
