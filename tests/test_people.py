import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.operators import managers as M
from dwellspark.operators.teams import (
    attach_contacts,
    attach_leaders,
    compose_team,
    contact_lookup,
    latest_leaders,
    split_team,
    team_type_counts,
)

D1, D2 = dt.date(2026, 8, 1), dt.date(2026, 8, 31)
ROSTER = (
    "seq long, lead_id string, deal_id string, report_date date, team_added_date date, member_tab_number string, "
    "member string, role string, is_leader string, tb string, team_type string"
)


def roster(spark, data):
    return spark.createDataFrame(data, ROSTER)


def test_newest_report_then_newest_added(spark):
    df = roster(
        spark,
        [
            (1, "1.0", "9", D1, D2, "5", "Old One", "r", "Да", "T", "1"),
            (2, "1", "9", D2, D1, "6", "Early One", "r", "Да", "T", "1"),
            (3, "1", "9", D2, D2, "7.0", "Late  One", "r1", " ДА ", "T", "1"),
            (4, "1", "9", D2, D2, "8", "Late Two", "r2", "yes", "T", "1"),
            (5, "1", "9", D2, D2, "9", "Late One", "dup", "1", "T", "1"),
            (6, "1", "9", D2, D2, "10", "Not Leader", "r", "Нет", "T", "1"),
            (7, "2", "-", D2, None, "11", "No Date", None, "Да", None, "1"),
            (8, "2", "-", D2, None, "12", "-", "x", "Да", None, "1"),
        ],
    )
    got = rows(latest_leaders(df, "lead_id"), "id", "name", "tab_number", "role")
    assert got == [("1", "Late One", "00000007", "r1"), ("1", "Late Two", "00000008", "r2"), ("2", "No Date", "00000011", None)]
    assert rows(latest_leaders(df, "deal_id"), "id", "name") == [("9", "Late One"), ("9", "Late Two")]
    without = df.drop("report_date", "team_added_date")
    assert latest_leaders(without, "lead_id").filter("id = '1'").count() == 4


def test_split_by_type(spark):
    df = roster(spark, [(i, "1", "1", D1, None, t[1], "N", "r", "Да", "T", t[0]) for i, t in enumerate([("1", "5"), ("2.0", "6"), ("-", "-"), ("-", "7"), (None, None), ("x", "8")])])
    lead, deal = split_team(df)
    assert (lead.count(), deal.count()) == (1, 1)
    assert rows(team_type_counts(df)) == [("deal", 1), ("lead", 1), ("unassigned", 2), ("unknown", 2)]


def leaders(spark, data):
    return spark.createDataFrame(data, "id string, name string, tab_number string, role string, tb string, seq long")


def test_team_merges_roles_of_one_person(spark):
    detail = spark.createDataFrame([("1", "D", "ivan petrov", "Vks One"), ("2", None, None, "-")], "lead_id string, deal_id string, km string, vks string")
    lead = leaders(spark, [("1", "Ivan Petrov", "00000001", "boss", "T", 2), ("1", "Anna", "00000002", "", "T", 1)])
    deal = leaders(spark, [("D", "IVAN PETROV", "00000001", "chief", "T", 1), ("x", "Nobody", None, None, None, 1)])
    got = compose_team(detail, lead, deal).orderBy("lead_id", "place").select("lead_id", "name", "roles").collect()
    assert [tuple(r) for r in got] == [
        ("1", "Anna", ["Команда лида · лидер"]),
        ("1", "Ivan Petrov", ["Команда лида · boss", "Команда сделки · chief", "КМ"]),
        ("1", "Vks One", ["ВКС"]),
    ]


def test_contacts_keep_the_order_of_the_leaders(spark):
    raw = spark.createDataFrame(
        [(1, "5", " ", "s5"), (2, "00000005", "a5", "late"), (3, "6", "a6", None), (4, "-", "x", "y")],
        "seq long, tab_number string, email_alpha string, email_sigma string",
    )
    book = contact_lookup(raw)
    assert rows(book) == [("00000005", "a5", "s5"), ("00000006", "a6", None)]
    who = leaders(spark, [("1", "B", "00000006", "r", "T", 2), ("1", "A", "00000009", "r", "T", 1), ("2", "C", "00000006", "r", "T", 1)])
    snap = spark.createDataFrame([("1.0",), ("2",), ("3",), ("-",)], "lead_id string")
    out = attach_leaders(snap, attach_contacts(who, book), "lead_id", "lead")
    assert rows(out, "lead_id", "lead_leader_members", "lead_leader_email_alpha", "lead_leader_email_sigma") == [
        ("-", None, None, None), ("1.0", "A\nB", "\na6", None), ("2", "C", "a6", None), ("3", None, None, None)
    ]


@pytest.fixture(scope="module")
def detail(spark):
    data = []
    for i in range(12):
        data.append(("T1", "M1" if i < 7 else "M2", "G", "A", "s1", "status", f"L{i:02d}", 10.0 + i, 8.0, True))
    data += [("T1", "M1", "G", "B", "s2", "status", "L00", 5.0, 8.0, False), ("T2", " ", "G", "A", "s1", "status", "L50", 50.0, 8.0, True), (None, "M3", "G", "A", "s1", "status", "L51", 50.0, 8.0, True)]
    return spark.createDataFrame(
        data,
        "tb string, km string, product_group string, product string, stage_key string, analysis_level string, lead_id string, days_int double, threshold_days double, exceeded boolean",
    )


def test_totals_and_top(detail):
    totals = M.manager_totals(detail)
    assert rows(totals) == [("T1", "M1", 7, 7), ("T1", "M2", 5, 5), (None, "M3", 1, 1)]
    assert rows(M.top_managers(totals, 1), "tb", "km", "rank") == [("T1", "M1", 1)]
    assert rows(M.violations_by_tb(totals)) == [("T1", 2, 2, 12)]


def test_stuck_items_order(detail):
    def leads(**options):
        items = M.stuck_items(detail.withColumn("seq", F.col("lead_id")), n=3, **options)
        return [r.lead_id for r in items.filter("km = 'M1'").orderBy("item").collect()]

    assert leads() == ["L06", "L05", "L04"]
    assert leads(order_before_limit=False) == ["L02", "L01", "L00"]


def test_hotspots_and_texts(detail):
    people = detail.withColumn("member_roles", F.array(F.lit("КМ"), F.lit("км"))).withColumn("client", F.lit(None).cast("string"))
    top = M.top_managers(M.manager_totals(people))
    spots = M.hotspots(M.exceedances_by_product(people), top)
    team = people.select("lead_id", F.lit("M1").alias("name"), F.struct(F.lit(1)).alias("place"), F.array(F.lit("КМ")).alias("roles")).distinct()
    ranked = M.ranked_with_hotspots(top, spots, M.stuck_items(people, spots, 2), team, ["lead_id"])
    got = ranked.filter("km = 'M1'").select(
        "roles_summary", M.hotspot_text(F.col("hotspots")).alias("h"), M.team_text(F.col("hotspots")).alias("t")
    ).first()
    assert got.roles_summary == "КМ"
    assert got.h == "1) G · A / s1: 7 сд., макс 16 дн. (P80=8, +8)"
    assert got.t == "L06: M1 (КМ)\nL05: M1 (КМ)"
    assert rows(M.top_grouped(top), "tb")[0] == ("T1",)


def test_summary_counts_a_lead_once(spark):
    snap = spark.createDataFrame(
        [("1", "D", "T1", "Km One", "-", "G", "A", True), ("2", None, "T1", "Km One", "Vks", "G", "A", True), ("3", None, "T2", "km one", None, "G", "B", True), ("4", None, "T2", "Km One", None, "", "", False)],
        "lead_id string, deal_id string, tb string, km string, vks string, product_group string, product string, exceeded boolean",
    )
    lead = leaders(spark, [("1", "Boss", "00000007", "r", "TL", 1)])
    deal = leaders(spark, [("D", "Boss", "00000007", "r2", "TD", 1), ("D", "Other", None, None, None, 2)])
    entries = M.manager_entries(snap, lead, deal)
    got = rows(M.manager_summary(entries), "manager_key", "name", "role", "tb", "exceeded_leads", "group_product")
    assert got == [
        ("FIO:km one", "Km One", "ВКО", "T1", 2, "G: A - 1 нарушений\nG: B - 1 нарушений"),
        ("FIO:other", "Other", "Лидер сделки", "T1", 1, "G: A - 1 нарушений"),
        ("FIO:vks", "Vks", "ВКС", "T1", 1, "G: A - 1 нарушений"),
        ("TN:00000007", "Boss", "r", "TL", 1, "G: A - 1 нарушений"),
    ]
    assert rows(M.violations(entries, snap), "manager_key", "lead_id", "manager_tb") == [
        ("FIO:km one", "2", "T1"), ("FIO:km one", "3", "T2"), ("FIO:other", "1", "T1"), ("FIO:vks", "2", "T1"), ("TN:00000007", "1", "TL")
    ]
