import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.operators.exceedance import exceedance, exceedance_detail, lead_records
from dwellspark.operators.filters import terminal_rows_out
from dwellspark.operators.matrix import duration_matrix, matrix_counts, matrix_percentiles, matrix_totals, wide_rows
from dwellspark.operators.norms import norms
from dwellspark.operators.pivots import (
    attach_status_days,
    ordered_stages,
    pivot_flat,
    pivot_matrix,
    status_pivot,
)
from dwellspark.operators.quality import lead_coverage
from dwellspark.operators.snapshot import lead_snapshot
from dwellspark.operators.tracking import add_durations, lead_stage_records, manager_records

SCHEMA = (
    "seq long, lead_id string, product_group string, product string, tb string, current_status string, "
    "deal_stage string, report_date date, days_on_stage double, days_since_deal double, km string"
)
D1, D2, D3 = dt.date(2026, 8, 1), dt.date(2026, 8, 15), dt.date(2026, 8, 31)


@pytest.fixture(scope="module")
def reports(spark):
    data = [
        (1, "L1", "G", "A", "T", "work", "-", D1, 5.0, 1.0, None),
        (2, "L1", "G", "A", "T", "work", "-", D1, 7.0, None, "M1"),
        (3, "L1", "G", "A", "T", "work", "open", D2, 7.0, 9.0, "M2"),
        (4, "L1", "G", "B", "T", "done", "open", D3, 2.0, 3.0, "M2"),
        (5, "L2", "G", "A", None, "work", "nan", D2, None, None, "M3"),
        (6, "L2", "G", "A", None, "work", "", D1, 4.0, 2.0, "M1"),
        (7, " ", "G", "A", "T", "work", "", D1, 4.0, 2.0, "M1"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_most_days_then_newest_date(reports):
    got = rows(lead_stage_records(reports), "lead_id", "product", "stage_key", "days_on_stage", "report_date", "days_since_deal", "km")
    assert got == sorted(
        [
            ("L1", "A", "work", 7.0, D2, 9.0, "M2"),
            ("L1", "B", "done", 2.0, D3, 3.0, "M2"),
            ("L2", "A", "work", 4.0, D1, 2.0, "M1"),
            (" ", "A", "work", 4.0, D1, 2.0, "M1"),
        ],
        key=repr,
    )


def test_first_value_skips_nulls_on_the_same_date(reports):
    day = reports.filter(F.col("report_date") == F.lit(D1))
    got = rows(lead_stage_records(day).filter("lead_id = 'L1'"), "days_on_stage", "days_since_deal", "km")
    assert got == [(7.0, 1.0, "M1")]


def test_substages_leave_empty_stages_out(reports):
    got = rows(lead_stage_records(reports, "substage"), "lead_id", "stage_key", "deal_stage", "analysis_level")
    assert got == [("L1", "open", "open", "substage")] * 2
    assert lead_stage_records(reports, "both").count() == 6


def test_group_only(reports):
    got = lead_stage_records(reports, product_mode="group_only")
    assert rows(got.filter("lead_id = 'L1'"), "product", "stage_key", "days_on_stage") == [
        ("—", "done", 2.0), ("—", "work", 7.0)
    ]


def test_manager_records_use_the_newest_date(reports):
    assert rows(manager_records(reports), "lead_id", "stage_key") == [("L1", "done")]
    assert manager_records(reports, latest_only=False).count() == 4


def test_terminal_row_drops_but_lead_stays(reports):
    out = terminal_rows_out(reports, {"x": {"enabled": True, "column_key": "deal_stage", "exclude_equals": "OPEN"}})
    got = rows(lead_stage_records(out).filter("lead_id = 'L1'"), "report_date", "days_on_stage")
    assert got == [(D1, 7.0)]


def test_durations_from_dates(spark):
    df = spark.createDataFrame(
        [(D3, D1, D2, "open", 1.0, 2.0), (D3, D1, None, "-", 1.0, 2.0), (D3, D1, None, "open", 1.0, 2.0), (None, D1, D2, "open", 1.0, 2.0)],
        "report_date date, work_start_date date, deal_created_date date, deal_stage string, days_on_stage double, days_since_deal double",
    )
    got = [tuple(r) for r in add_durations(df, "dates").select("days_on_stage", "days_since_deal").collect()]
    assert got == [(16.0, 16.0), (30.0, 2.0), (30.0, 2.0), (1.0, 2.0)]
    bare = [tuple(r) for r in add_durations(df, "dates", False).select("days_on_stage", "days_since_deal").collect()]
    assert bare[1] == (30.0, None) and bare[3] == (None, None)


def test_snapshot_takes_the_newest_filled_value(spark):
    df = spark.createDataFrame(
        [
            (1, "L1", D1, 3.0, "old", "M0", "x"),
            (2, "L1", D2, 9.0, "-", "M1", None),
            (3, "L1", D2, 8.0, "new", "nan", "y"),
            (4, "L1", None, 1.0, "undated", "M9", "z"),
            (5, "L2", None, 2.0, "only", None, None),
        ],
        "seq long, lead_id string, report_date date, days_on_stage double, current_status string, km string, sales_method string",
    )
    got = rows(lead_snapshot(df), "lead_id", "report_date", "days_on_stage", "current_status", "km", "sales_method")
    assert got == [("L1", D2, 9.0, "new", "M1", None), ("L2", None, 2.0, "only", None, None)]


def test_snapshot_does_not_depend_on_partitions(reports):
    assert rows(lead_snapshot(reports.repartition(7))) == rows(lead_snapshot(reports.coalesce(1)))


def test_status_columns(spark):
    df = spark.createDataFrame(
        [("1", "status", "К ПРОДАЖЕ", 5.5), ("1", "status", "к продаже", 6.5), ("1", "status", "Zeta", 1.0), ("2", "substage", "Zeta", 9.0), ("2", "status", "alpha", 2.0)],
        "lead_id string, analysis_level string, current_status string, days_on_stage double",
    )
    wide = status_pivot(df, ("К продаже", "Активация продукта"), ("alpha", "Zeta"))
    assert wide.columns == ["lead_id", "К продаже", "Активация продукта", "alpha", "Zeta"]
    assert rows(wide) == [("1", 6, None, None, 1), ("2", None, None, 2, None)]
    snap = spark.createDataFrame([("1", 7), ("3", 8)], "lead_id string, alpha int")
    assert rows(attach_status_days(snap, wide), "lead_id", "alpha", "Zeta") == [("1", None, 1), ("3", None, None)]


def test_exceedance_falls_back_to_overall(spark):
    rec = spark.createDataFrame(
        [(f"L{i}", "G", "A", "work", "T1", float(i)) for i in range(1, 11)],
        "lead_id string, product_group string, product string, current_status string, tb string, days_on_stage double",
    )
    table = norms(rec, km=None)
    snap = spark.createDataFrame(
        [("a", "G", "A", "work", "T1", 8.4), ("b", "G", "A", "work", "T1", 8.6), ("c", "G", "A", "work", "T9", 20.0), ("d", "G", "A", "other", "T1", 20.0), ("e", "G", "A", "work", "T1", None)],
        "lead_id string, product_group string, product string, current_status string, tb string, days_on_stage double",
    )
    got = rows(exceedance(snap, table), "lead_id", "norm_days", "current_days", "exceeded_flag", "exceeded_days")
    assert got == sorted(
        [("a", 8, 8.0, None, None), ("b", 8, 9.0, "ДА", 1.0), ("c", 8, 20.0, "ДА", 12.0), ("d", None, 20.0, None, None), ("e", 8, None, None, None)],
        key=repr,
    )
    raw = exceedance(snap, table, round_days=False, scope="overall")
    assert rows(raw.filter("exceeded"), "lead_id") == [("a",), ("b",), ("c",)]


def test_identity_only_when_exceeded(spark):
    rec = spark.createDataFrame(
        [("1", "G", "A", "s", "status", "T", "K", 1.0, "D1", "I", "ООО X", " V  V "), ("2", "G", "A", "s", "status", "T", None, 9.06, "D2", " ", "ООО Y", "-")],
        "lead_id string, product_group string, product string, stage_key string, analysis_level string, tb string, km string, days_on_stage double, deal_id string, inn string, client string, vks string",
    )
    table = norms(rec, ("product_group", "product", "stage_key", "analysis_level"), percentiles=(50,), km=None)
    got = rows(lead_records(exceedance_detail(rec, table, 50)), "lead_id", "days_int", "deal_id", "inn", "client", "vks", "km_tb_key")
    assert got == [("1", 1.0, None, None, None, None, "T|K"), ("2", 9.1, "D2", None, "ООО Y", None, "T|")]


def test_matrix(spark):
    df = spark.createDataFrame(
        [("b", "P1", "s", 5.2), ("b", "P1", "s", 5.0), ("b", "P2", "s", 7.0), ("A", "", "s", 7.0), ("", "", "s", 7.0), ("A", "Z", "", 1.0), ("A", "Z", "s", None)],
        "product_group string, product string, current_status string, days_on_stage double",
    )
    counts = matrix_counts(df)
    assert rows(counts) == [("A", "", 7, 1), ("A", "Z", 1, 1), ("b", "P1", 5, 2), ("b", "P2", 7, 1)]
    assert rows(matrix_totals(counts)) == [(1, 1), (5, 2), (7, 2), (None, 5)]
    assert matrix_counts(df, include_status=True).count() == 3
    assert rows(matrix_counts(df, max_days=1), "day") == [(5,)]
    assert rows(matrix_percentiles(counts), "product", "total", "p80") == [("", 1, 7), ("P1", 2, 5), ("P2", 1, 7), ("Z", 1, 1)]
    by_volume = duration_matrix(counts, layout="by_volume")
    assert rows(by_volume, "product", "row_position", "day_position") == [("", 2, 2), ("P1", 1, 1), ("P2", 4, 2), ("Z", 3, 3)]
    grouped = duration_matrix(counts, layout="group_alpha_product_volume")
    assert rows(grouped, "product", "row_position", "day_position") == [("", 1, 3), ("P1", 3, 2), ("P2", 4, 3), ("Z", 2, 1)]
    assert wide_rows(counts).filter("product = 'P1'").first().leads_by_day == {5: 2}


def test_pivot(spark):
    rec = spark.createDataFrame(
        [("G", "A", "x", "T1", 3.0), ("G", "A", "y", "T1", 4.0), ("G", "B", "x", "T2", 9.0)],
        "product_group string, product string, stage_key string, tb string, days_on_stage double",
    )
    flat = pivot_flat(norms(rec, ("product_group", "product", "stage_key"), km=None))
    matrix = pivot_matrix(flat, ["x", "y", "z"], ("row_key",), ["__ALL__"], "days_on_stage", "p80")
    assert rows(matrix) == [("A", 3, 4, None), ("B", 9, None, None)]
    assert ordered_stages(["x", "q", "End"], ["y", "x"], ["END"]) == ["y", "x", "q"]


def test_coverage(spark):
    a = spark.createDataFrame([("1",), (" 2 ",), ("",), (None,)], "lead_id string")
    b = spark.createDataFrame([("2",), ("3",)], "lead_id string")
    assert rows(lead_coverage(a, b)) == [("1", "missing"), ("3", "extra")]


def test_records_of_a_status_look_for_no_step(reports):
    """The step of the deal is empty there; without managers only numbers are kept, which are hashed."""
    got = lead_stage_records(reports.drop("km"))
    assert {r["deal_stage"] for r in got.collect()} == {""}
    assert got.columns == [c for c in lead_stage_records(reports).columns if c != "km"]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "min_by(" not in plan and "minby(" not in plan
