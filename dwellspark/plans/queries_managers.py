"""Queries for teams, contacts and managers."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellspark.operators import managers as M
from dwellspark.operators.exceedance import exceedance_detail
from dwellspark.operators.filters import ordered_filters, rank_pool
from dwellspark.operators.norms import norms
from dwellspark.operators.teams import (
    attach_contacts,
    attach_leaders,
    compose_team,
    latest_leaders,
    split_team,
)
from dwellspark.operators.tracking import lead_stage_records
from dwellspark.plans.fixtures import contacts, stage_reports, team_members
from dwellspark.plans.queries_norms import RUN_COLUMNS, run_exceedance, run_snapshot, stats_sql
from dwellspark.plans.queries_tracking import best_sql, daily_sql
from dwellspark.plans.registry import cte, query
from dwellspark.plans.settings import FILTERS, ORDER
from dwellspark.session import materialise

# --- leaders and contacts -----------------------------------------------------


def _leaders_sql(kind, id_col):
    return f"""SELECT id, name, lpad(arg_min(member_tab_number, seq), 8, '0') AS tab_number, arg_min(role, seq) AS role,
        arg_min(tb, seq) AS tb, min(seq) AS seq
        FROM (SELECT *, max(team_added_date) OVER (PARTITION BY id) AS newest_added FROM
               (SELECT {id_col} AS id, member AS name, member_tab_number, role, tb, team_added_date, seq,
                  report_date, max(report_date) OVER (PARTITION BY {id_col}) AS newest
                FROM tm WHERE is_leader = 'Да' AND team_type = '{kind}') WHERE report_date = newest)
        WHERE newest_added IS NULL OR team_added_date = newest_added GROUP BY id, name"""


cte("ll", _leaders_sql("1", "lead_id"))
cte("dl", _leaders_sql("2.0", "deal_id"))


def lead_leaders(spark, sf):
    return latest_leaders(split_team(team_members(spark, sf))[0], "lead_id")


def deal_leaders(spark, sf):
    return latest_leaders(split_team(team_members(spark, sf))[1], "deal_id")


@query(
    "q_latest_leaders",
    """SELECT 'lead' AS team, * EXCLUDE (seq) FROM ll UNION ALL SELECT 'deal', * EXCLUDE (seq) FROM dl""",
)
def q_latest_leaders(spark, sf):
    lead = lead_leaders(spark, sf).withColumn("team", F.lit("lead"))
    return lead.unionByName(deal_leaders(spark, sf).withColumn("team", F.lit("deal"))).drop("seq")


def _lines_sql(src, prefix, mails=False):
    parts = [
        f"string_agg({c}, chr(10) ORDER BY seq) AS {prefix}_leader_{name}"
        for c, name in (("tab_number", "tab_numbers"), ("name", "members"), ("role", "roles"), ("tb", "tbs"))
    ]
    if mails:
        parts += [
            f"CASE WHEN count({m}) > 0 THEN string_agg(coalesce({m}, ''), chr(10) ORDER BY seq) END AS {prefix}_leader_{m}"
            for m in ("email_alpha", "email_sigma")
        ]
    return f"SELECT id, {', '.join(parts)} FROM {src} GROUP BY id"


cte("lll", _lines_sql("ll", "lead"))
cte("dll", _lines_sql("dl", "deal"))


@query("q_lead_leaders", "SELECT s.*, l.* EXCLUDE (id) FROM rf_snap s LEFT JOIN lll l ON s.lead_id = l.id")
def q_lead_leaders(spark, sf):
    return attach_leaders(run_snapshot(spark, sf), lead_leaders(spark, sf), "lead_id", "lead").drop("lead_leaders")


@query("q_deal_leaders", "SELECT s.*, l.* EXCLUDE (id) FROM rf_snap s LEFT JOIN dll l ON s.deal_id = l.id")
def q_deal_leaders(spark, sf):
    return attach_leaders(run_snapshot(spark, sf), deal_leaders(spark, sf), "deal_id", "deal").drop("deal_leaders")


# Some numbers are not in the directory.
cte("ctp", "SELECT * FROM ct WHERE cast(tab_number AS bigint) % 5 <> 0")
cte("dlc", "SELECT dl.*, email_alpha, email_sigma FROM dl LEFT JOIN ctp ON dl.tab_number = ctp.tab_number")
cte("dlcl", _lines_sql("dlc", "deal", True))


def _known_contacts(spark, sf):
    return contacts(spark, sf).filter(F.col("tab_number").cast("long") % 5 != 0)


@query(
    "q_contact_multi",
    """SELECT s.lead_id, deal_leader_tab_numbers, deal_leader_email_alpha, deal_leader_email_sigma
       FROM rf_snap s LEFT JOIN dlcl l ON s.deal_id = l.id""",
)
def q_contact_multi(spark, sf):
    leaders = attach_contacts(deal_leaders(spark, sf), _known_contacts(spark, sf))
    out = attach_leaders(run_snapshot(spark, sf), leaders, "deal_id", "deal")
    return out.select("lead_id", "deal_leader_tab_numbers", "deal_leader_email_alpha", "deal_leader_email_sigma")


def _with_people(df, spark, sf):
    mails = _known_contacts(spark, sf)
    lead = attach_contacts(lead_leaders(spark, sf), mails)
    deal = attach_contacts(deal_leaders(spark, sf), mails)
    out = attach_leaders(df, lead, "lead_id", "lead")
    return attach_leaders(out, deal, "deal_id", "deal").drop("lead_leaders", "deal_leaders")


cte("llc", "SELECT ll.*, email_alpha, email_sigma FROM ll LEFT JOIN ctp ON ll.tab_number = ctp.tab_number")
cte("llcl", _lines_sql("llc", "lead", True))
_PEOPLE = "LEFT JOIN llcl ON s.lead_id = llcl.id LEFT JOIN dlcl ON s.deal_id = dlcl.id"

SOURCE_FILTERS = {
    "newest": {"enabled": True, "column_key": "report_date", "values": ["2000-06-01"], "match": "gte"},
    "efs": {"enabled": True, "column_key": "efs_flag", "values": [1]},
}


@query(
    "q_source_export",
    f"""SELECT s.line_key, s.lead_id, s.deal_id, s.report_date, llcl.* EXCLUDE (id), dlcl.* EXCLUDE (id)
        FROM (SELECT * FROM sr WHERE report_date >= DATE '2000-06-01' AND efs_flag = 1) s {_PEOPLE}""",
)
def q_source_export(spark, sf):
    rows = stage_reports(spark, sf, "line_key", "lead_id", "deal_id", "report_date", "efs_flag")
    return _with_people(ordered_filters(rows, SOURCE_FILTERS).drop("efs_flag"), spark, sf)


@query(
    "q_filtered_export",
    f"SELECT s.line_key, s.lead_id, s.deal_id, s.tb, llcl.* EXCLUDE (id), dlcl.* EXCLUDE (id) FROM rf s {_PEOPLE}",
)
def q_filtered_export(spark, sf):
    columns = [*[c for c in RUN_COLUMNS if c != "seq"], "line_key", "deal_id"]
    rows = ordered_filters(stage_reports(spark, sf, *columns), FILTERS, ORDER)
    return _with_people(rows.select("line_key", "lead_id", "deal_id", "tb"), spark, sf)


# --- detail of the run ------------------------------------------------------------

DETAIL_REST = ("deal_id", "inn", "client", "efs_flag", "change_conditions", "vks", "km", "label")
SPOT_KEYS = ("product_group", "product", "stage_key", "analysis_level")
RECORD = ("lead_id", "product_group", "product", "tb", "stage_key", "analysis_level")
cte("rd_day", daily_sql("rf", rest=DETAIL_REST))
cte("rd_rec", best_sql("rd_day", rest=DETAIL_REST))
cte("rd_d", "SELECT *, cast(round_even(days_on_stage, 0) AS bigint) AS d FROM rd_rec")
cte("rd_n", stats_sql("rd_d", SPOT_KEYS))
cte(
    "md",
    """SELECT m.*, m.days_on_stage AS days_int, t.days_on_stage_p80_days AS threshold_days,
       m.days_on_stage > t.days_on_stage_p80_days AS exceeded
       FROM rd_rec m JOIN rd_n t USING (product_group, product, stage_key, analysis_level)""",
)


def run_detail(spark, sf):
    """Records of the run against their overall norms."""
    columns = [*RUN_COLUMNS, *[c for c in DETAIL_REST if c not in RUN_COLUMNS]]
    rows = ordered_filters(stage_reports(spark, sf, *columns), FILTERS, ORDER)
    records = lead_stage_records(rows)
    return exceedance_detail(records, norms(records, SPOT_KEYS, km=None), keys=SPOT_KEYS)


_BY_PRODUCT = """SELECT tb, km, product_group, product, stage_key, analysis_level, count(lead_id) AS exceedance_count,
    cast(max(threshold_days) AS double) AS threshold_days, max(days_int) AS max_days,
    greatest(max(days_int) - max(threshold_days), 0) AS max_overshoot,
    greatest(avg(days_int) - max(threshold_days), 0) AS avg_overshoot
    FROM {src} WHERE exceeded GROUP BY tb, km, product_group, product, stage_key, analysis_level"""


@query("q_exceed_by_product", _BY_PRODUCT.format(src="md"))
def q_exceed_by_product(spark, sf):
    return M.exceedances_by_product(run_detail(spark, sf))


cte(
    "mt",
    """SELECT tb, km, count(DISTINCT lead_id) AS total_leads, count(*) FILTER (WHERE exceeded) AS exceedance_count
       FROM md GROUP BY tb, km""",
)


@query("q_manager_totals", "SELECT * FROM mt")
def q_manager_totals(spark, sf):
    return M.manager_totals(run_detail(spark, sf))


cte(
    "kb",
    """SELECT tb, count(*) FILTER (WHERE exceedance_count > 0) AS km_with_violations, count(*) AS km_total,
       cast(sum(exceedance_count) AS bigint) AS violation_deals FROM mt GROUP BY tb""",
)
cte(
    "kf",
    """SELECT tb, km, product_group, product, stage_key, count(lead_id) AS deals FROM md WHERE exceeded
       GROUP BY tb, km, product_group, product, stage_key""",
)
cte(
    "ks",
    """SELECT product_group || ' · ' || product AS segment, count(DISTINCT km) AS km_with_violations,
       cast(sum(deals) AS bigint) AS violation_deals FROM kf GROUP BY 1""",
)
cte(
    "kts",
    """SELECT tb, product_group || ' · ' || product AS segment, count(DISTINCT km) AS km_with_violations,
       cast(sum(deals) AS bigint) AS violation_deals FROM kf GROUP BY 1, 2""",
)


@query("q_km_by_tb", "SELECT * FROM kb")
def q_km_by_tb(spark, sf):
    return M.violations_by_tb(M.manager_totals(run_detail(spark, sf)))


@query("q_km_facts", "SELECT * FROM kf")
def q_km_facts(spark, sf):
    return M.km_facts(run_detail(spark, sf))


@query("q_facts_by_segment", "SELECT * FROM ks")
def q_facts_by_segment(spark, sf):
    return M.facts_by_segment(M.km_facts(run_detail(spark, sf)))


@query("q_facts_by_tb_segment", "SELECT * FROM kts")
def q_facts_by_tb_segment(spark, sf):
    return M.facts_by_segment(M.km_facts(run_detail(spark, sf)), ["tb"])


def _charts_sql(mode):
    if mode == "km_by_tb":
        summary = "SELECT 'summary' AS chart, 0 AS chart_order, bar, tb AS label, km_with_violations, violation_deals, km_total FROM pick"
        pick = "SELECT *, row_number() OVER (ORDER BY km_with_violations DESC, violation_deals DESC, tb) AS bar FROM kb"
        used = "pick WHERE bar <= 3"
    else:
        summary = """SELECT 'summary' AS chart, 0 AS chart_order, bar, segment AS label, km_with_violations, violation_deals, NULL AS km_total
            FROM (SELECT *, row_number() OVER (ORDER BY km_with_violations DESC, violation_deals DESC, segment) AS bar FROM ks) WHERE bar <= 3"""
        pick = "SELECT *, row_number() OVER (ORDER BY km_with_violations DESC, tb) AS bar FROM kb WHERE km_with_violations > 0"
        used = "pick WHERE bar <= 3"
    return f"""SELECT chart, cast(chart_order AS integer) AS chart_order, cast(bar AS integer) AS bar, label, km_with_violations, violation_deals, km_total FROM (
        WITH pick AS ({pick})
        {summary}
        UNION ALL
        SELECT tb, chart_order, bar, segment, km_with_violations, violation_deals, NULL FROM
          (SELECT kts.*, p.bar AS chart_order, row_number() OVER (PARTITION BY kts.tb ORDER BY kts.km_with_violations DESC,
             kts.violation_deals DESC, segment) AS bar FROM kts JOIN (SELECT * FROM {used}) p ON kts.tb = p.tb) WHERE bar <= 3)"""


def _charts(spark, sf, mode):
    detail = run_detail(spark, sf)
    return M.chart_groups(M.manager_totals(detail), M.km_facts(detail), mode, limit=3)


@query("q_km_charts", _charts_sql("km_by_tb"))
def q_km_charts(spark, sf):
    return _charts(spark, sf, "km_by_tb")


@query("q_km_charts_segments", _charts_sql("km_by_segment"))
def q_km_charts_segments(spark, sf):
    return _charts(spark, sf, "km_by_segment")


@query(
    "q_manager_dims",
    "SELECT DISTINCT 'product_group' AS dimension, product_group AS value FROM md UNION SELECT 'product', product FROM md",
)
def q_manager_dims(spark, sf):
    from dwellspark.operators.pivots import manager_dimensions

    return manager_dimensions(run_detail(spark, sf))


# --- teams of the records -----------------------------------------------------------

_R = ", ".join(RECORD)
cte(
    "te",
    f"""SELECT {_R}, 0 AS source, l.seq AS ord, l.name AS name, 'Команда лида · ' || l.role AS role FROM md JOIN ll l ON md.lead_id = l.id
        UNION ALL SELECT {', '.join('md.' + c for c in RECORD)}, 1, d.seq, d.name, 'Команда сделки · ' || d.role FROM md JOIN dl d ON md.deal_id = d.id
        UNION ALL SELECT {_R}, 2, NULL, km, 'КМ' FROM md
        UNION ALL SELECT {_R}, 3, NULL, vks, 'ВКС' FROM md""".replace(f"SELECT {_R}, 0", "SELECT " + ", ".join("md." + c for c in RECORD) + ", 0"),
)
cte(
    "tp",
    f"""SELECT {_R}, arg_min(name, row(source, ord)) AS name, min(row(source, ord)) AS place,
        list(role ORDER BY row(source, ord)) AS roles
        FROM (SELECT {_R}, lower(name) AS nk, arg_min(name, row(source, ord)) AS name, source, ord, role FROM te
              GROUP BY {_R}, nk, source, ord, role) GROUP BY {_R}, nk""",
)


def run_team(detail, spark, sf):
    return compose_team(detail, lead_leaders(spark, sf), deal_leaders(spark, sf), list(RECORD))


@query("q_team_compose", f"SELECT {_R}, name, array_to_string(roles, ' | ') AS roles FROM tp")
def q_team_compose(spark, sf):
    team = run_team(materialise(run_detail(spark, sf)), spark, sf)
    return team.select(*RECORD, "name", F.array_join("roles", " | ").alias("roles"))


cte(
    "mm",
    f"""SELECT md.* EXCLUDE (km), md.km AS km_source, tp.name AS km, tp.roles AS member_roles
        FROM md JOIN tp USING ({_R})""",
)


def run_members(spark, sf, keep=False):
    """Member x record rows, with the teams kept for the lists; ``keep`` writes these for a second use."""
    # The four sources of a team and the members all read the records.
    detail = materialise(run_detail(spark, sf))
    team = run_team(detail, spark, sf)
    team = materialise(team) if keep else team
    return M.explode_members(detail, team, list(RECORD)), team


@query(
    "q_explode_members",
    f"SELECT {_R}, km, km_source, exceeded, array_to_string(member_roles, ' | ') AS member_roles FROM mm",
)
def q_explode_members(spark, sf):
    people, _ = run_members(spark, sf)
    return people.select(*RECORD, "km", "km_source", "exceeded", F.array_join("member_roles", " | ").alias("member_roles"))


# --- ranking --------------------------------------------------------------------------

cte(
    "tt",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tb ORDER BY exceedance_count DESC, total_leads DESC, km) AS rank
         FROM (SELECT tb, km, count(DISTINCT lead_id) AS total_leads, count(*) FILTER (WHERE exceeded) AS exceedance_count
               FROM mm GROUP BY tb, km) WHERE exceedance_count > 0) WHERE rank <= 3""",
)
cte(
    "ts",
    f"""SELECT * FROM (SELECT tb, km, product_group, product, stage_key, analysis_level, exceedance_count,
          round_even(threshold_days, 1) AS threshold_days, round_even(max_days, 1) AS max_days,
          round_even(max_overshoot, 1) AS max_overshoot, round_even(avg_overshoot, 1) AS avg_overshoot,
          row_number() OVER (PARTITION BY tb, km ORDER BY exceedance_count DESC, round_even(max_overshoot, 1) DESC,
            stage_key, product_group, product) AS spot
        FROM ({_BY_PRODUCT.format(src='mm')}) SEMI JOIN tt USING (tb, km)) WHERE spot <= 5""",
)
cte(
    "ti",
    """SELECT * FROM (SELECT mm.*, round_even(greatest(days_int - mm.threshold_days, 0), 1) AS overshoot, ts.spot AS spot,
          row_number() OVER (PARTITION BY tb, km, product_group, product, stage_key
            ORDER BY round_even(greatest(days_int - mm.threshold_days, 0), 1) DESC, lead_id, mm.analysis_level) AS item
        FROM mm JOIN ts USING (tb, km, product_group, product, stage_key) WHERE mm.exceeded) WHERE item <= 15""",
)


def run_ranking(spark, sf, n=3, keep=False):
    """Ranked members, their hotspots and stuck leads."""
    people, team = run_members(spark, sf, keep)
    # Three results read these rows, so they are written once.
    people = materialise(people)
    top = M.top_managers(M.manager_totals(people), n)
    spots = M.hotspots(M.exceedances_by_product(people), top)
    items = M.stuck_items(people, spots)
    return top, spots, items, team


@query("q_top_managers", "SELECT tb, km, total_leads, exceedance_count, cast(rank AS integer) AS rank FROM tt")
def q_top_managers(spark, sf):
    people, _ = run_members(spark, sf)
    return M.top_managers(M.manager_totals(people))


@query("q_hotspots", "SELECT * REPLACE (cast(spot AS integer) AS spot) FROM ts")
def q_hotspots(spark, sf):
    return run_ranking(spark, sf)[1]


@query(
    "q_stuck_items",
    "SELECT tb, km, product_group, product, stage_key, cast(item AS integer) AS item, lead_id, deal_id, inn, client, days_int, threshold_days, overshoot, array_to_string(member_roles, ' | ') AS member_roles FROM ti",
)
def q_stuck_items(spark, sf):
    items = run_ranking(spark, sf)[2]
    return items.select(
        "tb", "km", "product_group", "product", "stage_key", "item", "lead_id", "deal_id", "inn", "client",
        "days_int", "threshold_days", "overshoot", F.array_join("member_roles", " | ").alias("member_roles"),
    )


cte(
    "tr",
    """SELECT tb, km, string_agg(role, ', ' ORDER BY place) AS roles_summary FROM
         (SELECT tb, km, lower(role) AS rk, arg_min(role, row(spot, item, i)) AS role, min(row(spot, item, i)) AS place FROM
            (SELECT tb, km, spot, item, unnest(member_roles) AS role, generate_subscripts(member_roles, 1) AS i FROM ti)
          GROUP BY tb, km, rk) GROUP BY tb, km""",
)


def run_ranked(spark, sf):
    # Items read the teams again, so records and rosters are joined once.
    top, spots, items, team = run_ranking(spark, sf, keep=True)
    items = materialise(items)
    return M.ranked_with_hotspots(top, spots, items, team, list(RECORD))


@query(
    "q_roles_summary",
    """SELECT tt.tb, tt.km, cast(rank AS integer) AS rank, roles_summary, tt.tb || '|' || tt.km AS km_tb_key FROM tt JOIN tr USING (tb, km)""",
)
def q_roles_summary(spark, sf):
    return run_ranked(spark, sf).select("tb", "km", "rank", "roles_summary", "km_tb_key")


@query(
    "q_hotspot_text",
    """SELECT tb, km, string_agg(spot || ') ' || product_group || ' · ' || product || ' / ' || stage_key || ': ' || exceedance_count
         || ' сд., макс ' || cast(round_even(max_days, 0) AS bigint) || ' дн. (P80=' || cast(round_even(threshold_days, 0) AS bigint)
         || ', +' || cast(round_even(max_overshoot, 0) AS bigint) || ')', chr(10) ORDER BY spot) AS hotspots_summary
       FROM ts GROUP BY tb, km""",
)
def q_hotspot_text(spark, sf):
    return run_ranked(spark, sf).select("tb", "km", M.hotspot_text(F.col("hotspots")).alias("hotspots_summary"))


cte(
    "tx",
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tb, km ORDER BY spot, item) AS nr FROM
          (SELECT *, row_number() OVER (PARTITION BY tb, km, lead_id ORDER BY spot, item) AS once FROM ti) WHERE once = 1) WHERE nr <= 8""",
)


@query(
    "q_team_text",
    f"""SELECT tb, km, string_agg(line, chr(10) ORDER BY nr) AS team_summary FROM
         (SELECT tx.tb, tx.km, nr, any_value(client) || ' / ' || tx.lead_id || ': '
            || string_agg(tp.name || ' (' || array_to_string(tp.roles, ', ') || ')', '; ' ORDER BY tp.place) AS line
          FROM tx JOIN tp USING ({_R}) GROUP BY tx.tb, tx.km, nr, tx.lead_id) GROUP BY tb, km""",
)
def q_team_text(spark, sf):
    return run_ranked(spark, sf).select("tb", "km", M.team_text(F.col("hotspots")).alias("team_summary"))


@query(
    "q_top_grouped",
    "SELECT tb, string_agg(rank || ' ' || km || ' ' || exceedance_count || ' ' || total_leads, '; ' ORDER BY rank) AS managers FROM tt GROUP BY tb",
)
def q_top_grouped(spark, sf):
    people, _ = run_members(spark, sf)
    grouped = M.top_grouped(M.top_managers(M.manager_totals(people)))
    text = F.transform(
        "managers", lambda m: F.concat_ws(" ", m["rank"], m["km"], m["exceedance_count"], m["total_leads"])
    )
    return grouped.select("tb", F.array_join(text, "; ").alias("managers"))


_POOL = "product_group IN ('ECONOMY', 'SMALL', 'PROMO') AND label LIKE '%r%' AND tb IN ('ASIA', 'EUROPE')"
cte(
    "ft",
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tb ORDER BY exceedance_count DESC, total_leads DESC, km) AS rank
         FROM (SELECT tb, km, count(DISTINCT lead_id) AS total_leads, count(*) FILTER (WHERE exceeded) AS exceedance_count
               FROM md WHERE {_POOL} GROUP BY tb, km) WHERE exceedance_count > 0) WHERE rank <= 2""",
)


@query("q_top_managers_filtered", "SELECT tb, km, total_leads, exceedance_count, cast(rank AS integer) AS rank FROM ft")
def q_top_managers_filtered(spark, sf):
    pool = rank_pool(run_detail(spark, sf), ["ECONOMY", "SMALL", "PROMO"], label_mode=F.col("label").contains("r"))
    return M.top_managers(M.manager_totals(pool.filter(F.col("tb").isin("ASIA", "EUROPE"))), 2)


# --- summary of all managers --------------------------------------------------------------

cte(
    "en",
    """SELECT coalesce('TN:' || tab_number, 'FIO:' || lower(name)) AS manager_key, * FROM (
         SELECT ex.lead_id, 0 AS source, ll.seq AS ord, ll.tab_number, ll.name, ll.role, ll.tb,
           product_group || ': ' || product AS group_product, exceeded FROM ex JOIN ll ON ex.lead_id = ll.id
         UNION ALL SELECT ex.lead_id, 1, dl.seq, dl.tab_number, dl.name, dl.role, dl.tb, product_group || ': ' || product, exceeded
           FROM ex JOIN dl ON ex.deal_id = dl.id
         UNION ALL SELECT lead_id, 2, NULL, NULL, km, 'ВКО', tb, product_group || ': ' || product, exceeded FROM ex
           WHERE lead_id NOT IN (SELECT id FROM ll) AND deal_id NOT IN (SELECT id FROM dl)
         UNION ALL SELECT lead_id, 3, NULL, NULL, vks, 'ВКС', tb, product_group || ': ' || product, exceeded FROM ex
           WHERE lead_id NOT IN (SELECT id FROM ll) AND deal_id NOT IN (SELECT id FROM dl))""",
)


def run_entries(spark, sf, snap=None):
    snap = materialise(run_exceedance(spark, sf)) if snap is None else snap
    # Each leader table is read twice: for the leaders and for the leads without any.
    return M.manager_entries(snap, materialise(lead_leaders(spark, sf)), materialise(deal_leaders(spark, sf)))


@query("q_manager_entries", "SELECT * EXCLUDE (ord) REPLACE (cast(source AS integer) AS source) FROM en")
def q_manager_entries(spark, sf):
    return run_entries(spark, sf).drop("ord")


cte(
    "es",
    """SELECT w.*, coalesce(g.group_product, '') AS group_product FROM
        (SELECT manager_key, arg_min_null(tab_number, row(lead_id, source, ord)) AS tab_number, arg_min(name, row(lead_id, source, ord)) AS name,
           arg_min(role, row(lead_id, source, ord)) AS role, arg_min(tb, row(lead_id, source, ord)) AS tb,
           count(DISTINCT lead_id) FILTER (WHERE exceeded) AS exceeded_leads FROM en GROUP BY manager_key) w
        LEFT JOIN (SELECT manager_key, string_agg(group_product || ' - ' || n || ' нарушений', chr(10) ORDER BY n DESC, group_product) AS group_product
           FROM (SELECT manager_key, group_product, count(DISTINCT lead_id) AS n FROM en WHERE exceeded GROUP BY 1, 2) GROUP BY 1) g
        ON w.manager_key = g.manager_key""",
)


@query("q_manager_summary", "SELECT * FROM es")
def q_manager_summary(spark, sf):
    return M.manager_summary(run_entries(spark, sf))


@query(
    "q_contact_managers",
    "SELECT es.manager_key, es.tab_number, exceeded_leads, email_alpha, email_sigma FROM es LEFT JOIN ctp ON es.tab_number = ctp.tab_number",
)
def q_contact_managers(spark, sf):
    summary = M.manager_summary(run_entries(spark, sf))
    out = attach_contacts(summary, _known_contacts(spark, sf))
    return out.select("manager_key", "tab_number", "exceeded_leads", "email_alpha", "email_sigma")


@query(
    "q_violations",
    """SELECT manager_key, tab_number, name, role, manager_tb, ex.* EXCLUDE (exceeded), current_days - norm_days AS exceeded_days FROM
         (SELECT manager_key, lead_id, arg_min_null(tab_number, row(source, ord)) AS tab_number, arg_min(name, row(source, ord)) AS name,
            arg_min(role, row(source, ord)) AS role, arg_min(tb, row(source, ord)) AS manager_tb
          FROM en WHERE exceeded GROUP BY manager_key, lead_id) v JOIN ex ON v.lead_id = ex.lead_id""",
)
def q_violations(spark, sf):
    snap = materialise(run_exceedance(spark, sf))
    return M.violations(run_entries(spark, sf, snap), snap)
