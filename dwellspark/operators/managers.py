"""Rollups per manager: totals, rankings, hotspots, stuck leads, summaries.

Lists are only collected after a top-n cut, so their length is bounded by the
parameters of the report and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import (
    client_name,
    id_token,
    manager_key,
    person_name,
    territory_manager_key,
)
from dwellspark.operators.ranking import first_numbered, numbered
from dwellspark.operators.norms import attach
from dwellspark.operators.teams import beside_leaders, distinct_roles

SPOT = ("tb", "km", "product_group", "product", "stage_key", "analysis_level")


def exceedances_by_product(detail: DataFrame, keys: Sequence[str] = SPOT) -> DataFrame:
    """Exceedances per manager, product and stage, with the overshoot floored at 0."""
    over = detail.filter("exceeded").groupBy(*keys).agg(
        F.count("lead_id").alias("exceedance_count"),
        F.max("threshold_days").cast("double").alias("threshold_days"),
        F.max("days_int").alias("max_days"),
        F.avg("days_int").alias("_avg"),
    )
    return over.withColumns(
        {
            "max_overshoot": F.greatest(F.col("max_days") - F.col("threshold_days"), F.lit(0.0)),
            "avg_overshoot": F.greatest(F.col("_avg") - F.col("threshold_days"), F.lit(0.0)),
        }
    ).drop("_avg")


def manager_totals(detail: DataFrame) -> DataFrame:
    """Distinct leads and exceedances of every named manager of a territory."""
    named = detail.filter(person_name(F.col("km")).isNotNull())
    return named.groupBy("tb", "km").agg(
        F.count_distinct("lead_id").alias("total_leads"),
        F.count_if("exceeded").alias("exceedance_count"),
    )


def top_managers(totals: DataFrame, n: int = 3) -> DataFrame:
    """The n managers of each territory with the most exceedances."""
    order = Window.partitionBy("tb").orderBy(F.desc("exceedance_count"), F.desc("total_leads"), F.asc("km"))
    pool = totals.filter((F.col("exceedance_count") > 0) & F.col("tb").isNotNull())
    return pool.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def explode_members(detail: DataFrame, team: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Member x record rows; a record without a team counts for its manager.

    `team` is the long form of compose_team on the same keys.
    """
    members = team.select(*keys, F.col("name").alias("m_name"), F.col("roles").alias("m_roles"))
    joined = attach(detail, members, list(keys))
    alone = F.when(F.col("m_name").isNull(), person_name(F.col("km")))
    out = joined.withColumns(
        {
            "km_source": F.col("km"),
            "member_roles": F.when(F.col("m_name").isNotNull(), F.col("m_roles")).otherwise(F.array(F.lit(K.ROLE_KM))),
            "km": F.coalesce("m_name", alone),
        }
    )
    return out.drop("m_name", "m_roles").filter(F.col("km").isNotNull())


def hotspots(by_product: DataFrame, top: DataFrame | None = None, n: int = 5) -> DataFrame:
    """The n worst product-stage zones of every manager (of the ranked ones if `top` is given)."""
    spots = by_product
    if top is not None:
        chosen = top.select(F.col("tb").alias("t_tb"), F.col("km").alias("t_km"))
        spots = spots.join(chosen, (F.col("tb") == F.col("t_tb")) & (F.col("km") == F.col("t_km")), "left_semi")
    spots = spots.withColumns(
        {c: F.bround(c, 1) for c in ("threshold_days", "max_days", "max_overshoot", "avg_overshoot")}
    )
    order = Window.partitionBy("tb", "km").orderBy(
        F.desc("exceedance_count"), F.desc("max_overshoot"), "stage_key", "product_group", "product"
    )
    return spots.withColumn("spot", F.row_number().over(order)).filter(F.col("spot") <= n)


STUCK_KEYS = ("tb", "km", "product_group", "product", "stage_key")


def stuck_items(
    detail: DataFrame,
    spots: DataFrame | None = None,
    n: int = 15,
    order_before_limit: bool = True,
    seq: str = "seq",
) -> DataFrame:
    """The n leads of a hotspot furthest over the norm.

    With `order_before_limit=False` the first n in row order are kept and then sorted.
    """
    over = detail.filter("exceeded")
    if spots is not None:
        s = spots.select(*[F.col(c).alias(f"s_{c}") for c in STUCK_KEYS]).distinct()
        on = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in STUCK_KEYS]
        over = over.join(s, on, "left_semi")
    gap = F.greatest(F.coalesce("days_int", F.lit(0.0)) - F.coalesce("threshold_days", F.lit(0.0)), F.lit(0.0))
    items = over.withColumn("overshoot", F.bround(gap, 1))
    if "client" in items.columns:
        items = items.withColumn("client", client_name(F.col("client")))
    place = Window.partitionBy(*STUCK_KEYS)
    worst = place.orderBy(F.desc("overshoot"), "lead_id", "analysis_level")
    if order_before_limit:
        return items.withColumn("item", F.row_number().over(worst)).filter(F.col("item") <= n)
    first = items.withColumn("_nr", F.row_number().over(place.orderBy(seq))).filter(F.col("_nr") <= n)
    return first.drop("_nr").withColumn("item", F.row_number().over(worst))


def ranked_with_hotspots(
    top: DataFrame, spots: DataFrame, items: DataFrame, team: DataFrame | None = None,
    team_keys: Sequence[str] = (),
) -> DataFrame:
    """One row per ranked manager: hotspots with their stuck leads, and the roles held there."""
    fields = ["item", "lead_id", "deal_id", "inn", "client", "days_int", "threshold_days", "overshoot", "member_roles"]
    kept = items
    if team is not None:
        # Only leads that are in a list get their team.
        need = items.select(*team_keys).distinct()
        mine = attach(team, need.withColumn("_in", F.lit(True)), list(team_keys), "inner").drop("_in")
        listed = mine.groupBy(*team_keys).agg(
            F.array_sort(F.collect_list(F.struct("place", "name", "roles"))).alias("_team")
        )
        listed = listed.withColumn(
            "team", F.transform("_team", lambda p: F.struct(p["name"].alias("name"), p["roles"].alias("roles")))
        ).drop("_team")
        kept = attach(items, listed, list(team_keys))
        fields.append("team")
    present = [f for f in fields if f in kept.columns]
    per_spot = kept.groupBy(*STUCK_KEYS).agg(F.array_sort(F.collect_list(F.struct(*present))).alias("stuck_items"))
    zone = attach(spots, per_spot, list(STUCK_KEYS))
    columns = [
        "spot", "product_group", "product", "stage_key", "exceedance_count",
        "threshold_days", "max_days", "max_overshoot", "avg_overshoot", "stuck_items",
    ]
    per_manager = zone.groupBy("tb", "km").agg(
        F.array_sort(F.collect_list(F.struct(*columns))).alias("hotspots")
    )
    out = attach(top, per_manager, ["tb", "km"])
    if "member_roles" in present:
        roles = F.flatten(
            F.transform(
                F.col("hotspots"),
                lambda h: F.flatten(
                    F.transform(
                        F.coalesce(h["stuck_items"], F.array().cast(zone.schema["stuck_items"].dataType)),
                        lambda s: F.coalesce(s["member_roles"], F.array().cast("array<string>")),
                    )
                ),
            )
        )
        out = out.withColumn("member_roles", distinct_roles(F.coalesce(roles, F.array().cast("array<string>"))))
    else:
        out = out.withColumn("member_roles", F.array().cast("array<string>"))
    return out.withColumns(
        {
            "km_tb_key": territory_manager_key(F.col("tb"), F.col("km")),
            "roles_summary": F.when(F.size("member_roles") > 0, F.array_join("member_roles", ", ")).otherwise(F.lit("—")),
        }
    )


def _whole(c: Column) -> Column:
    return F.format_string("%d", F.bround(c).cast("long"))


def hotspot_text(spots: Column, group_only: bool = False) -> Column:
    """Hotspots of a manager, one line each."""
    zone = F.transform(
        spots,
        lambda h: F.concat(
            h["spot"].cast("string"),
            F.lit(") "),
            h["product_group"] if group_only else F.concat(h["product_group"], F.lit(" · "), h["product"]),
            F.lit(" / "),
            h["stage_key"],
            F.lit(": "),
            h["exceedance_count"].cast("string"),
            F.lit(" сд., макс "),
            _whole(h["max_days"]),
            F.lit(" дн. (P80="),
            _whole(h["threshold_days"]),
            F.lit(", +"),
            _whole(h["max_overshoot"]),
            F.lit(")"),
        ),
    )
    return F.when(F.coalesce(F.size(spots), F.lit(0)) > 0, F.array_join(zone, "\n")).otherwise(F.lit("—"))


def team_text(spots: Column, limit: int = 8) -> Column:
    """Teams of the first distinct stuck leads, one line each."""
    items = F.flatten(F.transform(spots, lambda h: h["stuck_items"]))

    def once(seen: Column, item: Column) -> Column:
        known = F.exists(seen, lambda s: s["lead_id"] == item["lead_id"])
        return F.when(known, seen).otherwise(F.concat(seen, F.array(item)))

    def line(item: Column) -> Column:
        people = F.transform(
            item["team"],
            lambda m: F.when(
                F.size(m["roles"]) > 0,
                F.concat(m["name"], F.lit(" ("), F.array_join(m["roles"], ", "), F.lit(")")),
            ).otherwise(m["name"]),
        )
        head = F.when(
            F.coalesce(item["client"], F.lit("")) != "",
            F.concat(item["client"], F.lit(" / "), item["lead_id"]),
        ).otherwise(item["lead_id"])
        return F.concat(head, F.lit(": "), F.array_join(people, "; "))

    with_team = F.filter(items, lambda i: F.coalesce(F.size(i["team"]), F.lit(0)) > 0)
    empty = F.slice(with_team, 1, 0)
    distinct = F.aggregate(with_team, empty, once)
    lines = F.transform(F.slice(distinct, 1, limit), line)
    return F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise(F.lit("—"))


def top_grouped(top: DataFrame) -> DataFrame:
    """Ranked managers gathered per territory."""
    rows = F.struct("rank", "km", "exceedance_count", "total_leads")
    return top.groupBy("tb").agg(F.array_sort(F.collect_list(rows)).alias("managers"))


# --- charts ---------------------------------------------------------------


def violations_by_tb(totals: DataFrame) -> DataFrame:
    """Managers with violations, all managers and violating deals per territory."""
    over = F.col("exceedance_count") > 0
    return totals.filter(F.col("tb").isNotNull()).groupBy("tb").agg(
        F.count_if(over).alias("km_with_violations"),
        F.count(F.lit(1)).alias("km_total"),
        F.coalesce(F.sum("exceedance_count"), F.lit(0)).alias("violation_deals"),
    )


FACT = ("tb", "km", "product_group", "product", "stage_key")


def km_facts(detail: DataFrame, keys: Sequence[str] = FACT) -> DataFrame:
    """Violating deals per territory, manager, product and stage."""
    return detail.filter("exceeded").groupBy(*keys).agg(F.count("lead_id").alias("deals"))


def segment_label(group_only: bool = False) -> Column:
    if group_only:
        return F.col("product_group")
    return F.concat(F.col("product_group"), F.lit(" · "), F.coalesce(F.when(F.col("product") != "", F.col("product")), F.lit("—")))


def facts_by_segment(facts: DataFrame, within: Sequence[str] = (), group_only: bool = False) -> DataFrame:
    """Distinct managers and deals per segment, optionally inside a territory."""
    return facts.groupBy(*within, segment_label(group_only).alias("segment")).agg(
        F.count_distinct("km").alias("km_with_violations"), F.sum("deals").alias("violation_deals")
    )


def chart_groups(
    totals: DataFrame, facts: DataFrame, mode: str = "km_by_tb", limit: int = 8, group_only: bool = False
) -> DataFrame:
    """Bars of the manager charts: one summary chart, then one per territory, each cut to `limit`.

    Columns: chart, chart_order, bar, label, km_with_violations, violation_deals, km_total.
    """
    by_tb = violations_by_tb(totals)
    order = [F.desc("km_with_violations"), F.desc("violation_deals"), F.asc("tb")]
    if mode == "km_by_tb":
        ranked = numbered(by_tb, order, "bar")
        summary = ranked.select(
            F.lit("summary").alias("chart"), F.lit(0).alias("chart_order"), "bar",
            F.col("tb").alias("label"), "km_with_violations", "violation_deals", "km_total",
        )
        picked = ranked.filter(F.col("bar") <= limit)
    else:
        segments = facts_by_segment(facts, group_only=group_only)
        place = [F.desc("km_with_violations"), F.desc("violation_deals"), F.col("segment")]
        summary = (
            first_numbered(segments, place, limit, "bar")
            .select(
                F.lit("summary").alias("chart"), F.lit(0).alias("chart_order"), "bar",
                F.col("segment").alias("label"), "km_with_violations", "violation_deals",
                F.lit(None).cast("long").alias("km_total"),
            )
        )
        most = [F.desc("km_with_violations"), F.asc("tb")]
        picked = first_numbered(by_tb.filter(F.col("km_with_violations") > 0), most, limit, "bar")
    inner = facts_by_segment(facts, ["tb"], group_only)
    p = picked.select(F.col("tb").alias("p_tb"), F.col("bar").alias("chart_order"))
    place = Window.partitionBy("tb").orderBy(F.desc("km_with_violations"), F.desc("violation_deals"), "segment")
    details = (
        inner.join(p, F.col("tb") == F.col("p_tb"))
        .withColumn("bar", F.row_number().over(place))
        .filter(F.col("bar") <= limit)
        .select(
            F.col("tb").alias("chart"), "chart_order", "bar", F.col("segment").alias("label"),
            "km_with_violations", "violation_deals", F.lit(None).cast("long").alias("km_total"),
        )
    )
    return summary.unionByName(details)


# --- summary of all managers ------------------------------------------------


def manager_entries(
    snapshot: DataFrame, lead_leaders: DataFrame, deal_leaders: DataFrame
) -> DataFrame:
    """Manager x lead rows: the leaders if the lead has any, else its two managers.

    Needs lead_id, deal_id, tb, km, vks, product_group, product and exceeded.
    `ord` is the order of the entries: lead, source, leader. The snapshot is read once and joined once
    with each roster; the managers are those of rows that found nobody.
    """
    group, product = F.coalesce("product_group", F.lit("")), F.coalesce("product", F.lit(""))
    gp = F.when((group != "") | (product != ""), F.concat(group, F.lit(": "), product)).otherwise(F.lit(""))
    base = snapshot.select(
        "lead_id",
        id_token(F.col("lead_id")).alias("_lead"),
        id_token(F.col("deal_id")).alias("_deal"),
        F.col("tb").alias("lead_tb"),
        "km",
        "vks",
        gp.alias("group_product"),
        "exceeded",
    )
    rows = beside_leaders(base, lead_leaders, deal_leaders, F.col("_lead"), F.col("_deal"))
    no_order = F.lit(None).cast(lead_leaders.schema["seq"].dataType)

    def leader(p: str, here: Column, source: int, role: str) -> Column:
        return F.when(
            here,
            F.struct(
                F.lit(source).alias("source"),
                F.col(f"{p}_seq").alias("ord"),
                F.col(f"{p}_tab_number").alias("tab_number"),
                F.col(f"{p}_name").alias("name"),
                F.coalesce(F.when(F.col(f"{p}_role") != "", F.col(f"{p}_role")), F.lit(role)).alias("role"),
                F.coalesce(F.when(F.col(f"{p}_tb") != "", F.col(f"{p}_tb")), F.col("lead_tb"), F.lit("")).alias("tb"),
            ),
        )

    def manager(column: str, source: int, role: str) -> Column:
        name = person_name(F.col(column))
        alone = F.col("_l_no").isNull() & F.col("_d_no").isNull()
        return F.when(
            alone & name.isNotNull(),
            F.struct(
                F.lit(source).alias("source"),
                no_order.alias("ord"),
                F.lit(None).cast("string").alias("tab_number"),
                name.alias("name"),
                F.lit(role).alias("role"),
                F.coalesce("lead_tb", F.lit("")).alias("tb"),
            ),
        )

    found = F.array(
        leader("_l", F.col("_l_here"), 0, K.ROLE_LEAD_LEADER),
        leader("_d", F.col("_d_no").isNotNull(), 1, K.ROLE_DEAL_LEADER),
        manager("km", 2, K.ROLE_KM_SUMMARY),
        manager("vks", 3, K.ROLE_VKS),
    )
    entries = rows.select("lead_id", "group_product", "exceeded", F.inline(F.array_compact(found)))
    return entries.withColumn("manager_key", manager_key(F.col("tab_number"), F.col("name")))


def _first_seen(*columns: str) -> Column:
    return F.min_by(F.struct(*columns), F.struct("lead_id", "source", "ord"))


def manager_summary(entries: DataFrame) -> DataFrame:
    """Distinct leads over the norm per manager, with a text by group and product.

    Name, role and territory are those of the first entry.
    """
    per_lead = entries.groupBy("manager_key", "lead_id").agg(
        _first_seen("tab_number", "name", "role", "tb").alias("who"),
        F.min(F.struct("lead_id", "source", "ord")).alias("place"),
        F.max("exceeded").alias("exceeded"),
        F.min_by("group_product", F.struct("source", "ord")).alias("gp"),
    )
    per_segment = per_lead.groupBy("manager_key", "gp").agg(
        F.min_by("who", "place").alias("who"), F.min("place").alias("place"), F.count_if("exceeded").alias("leads")
    )
    listed = F.col("leads") > 0
    out = per_segment.groupBy("manager_key").agg(
        F.min_by("who", "place").alias("who"),
        F.sum("leads").alias("exceeded_leads"),
        # As many entries as there are groups and products.
        F.array_sort(
            F.collect_list(F.when(listed & (F.col("gp") != ""), F.struct((-F.col("leads")).alias("less"), "gp")))
        ).alias("gps"),
    )
    text = F.transform(
        "gps", lambda g: F.concat(g["gp"], F.lit(" - "), (-g["less"]).cast("string"), F.lit(" нарушений"))
    )
    return out.select(
        "manager_key", "who.*", "exceeded_leads", F.array_join(text, "\n").alias("group_product")
    ).orderBy(F.desc("exceeded_leads"), "manager_key")


def violations(entries: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row per manager and lead over the norm, with the fields of the lead."""
    once = entries.filter("exceeded").groupBy("manager_key", F.col("lead_id").alias("v_lead")).agg(
        F.min_by(F.struct("tab_number", "name", "role", F.col("tb").alias("manager_tb")), F.struct("source", "ord")).alias("who")
    )
    lead = snapshot.drop("exceeded", "exceeded_flag")
    return once.join(lead, F.col("v_lead") == F.col("lead_id")).select("manager_key", "who.*", *lead.columns)
