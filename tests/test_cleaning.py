import datetime as dt

import pytest
from pyspark.sql import functions as F

from dwellspark.functions.dates import date_value, parse_date
from dwellspark.functions.output import json_safe, safe_text
from dwellspark.functions.text import (
    client_name,
    double_id,
    id_token,
    is_empty,
    person_name,
    source_category,
    tab_number,
    tab_number_lines,
    team_type,
    text_id,
)
from dwellspark.sources.reports import find_column, project_required


def test_text_ids(column):
    values = ["1234567890123", " 77.0 ", "1.23456789012E+11", "1.5e0", "-", "nan", None, "+5.00", "A-1", "0012"]
    want = ["1234567890123", "77", "123456789012", "1.5", None, None, None, "5", "A-1", "0012"]
    assert column(values, text_id) == want


def test_double_ids(spark):
    df = spark.createDataFrame([(12345678901.0,), (2.5,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(double_id(F.col("v"))).collect()] == ["12345678901", "2.5", None, None, None]


def test_tab_numbers(column):
    values = ["123", "00000123", "123.0", "TN 12-3", "123456789", "000123456789", "-", "", None, "0", "12,5"]
    want = [
        "00000123", "00000123", "00000123", "00000123", "123456789", "123456789", None, None, None, "00000000",
        "00000125",
    ]
    assert column(values, tab_number) == want


def test_tab_number_lines(column):
    assert column(["1\n-\n 22 ", "7", "-", None], tab_number_lines) == ["00000001\n00000022", "00000007", None, None]


def test_tokens(column):
    assert column(["12.0", "-3.0", "1.50", " x ", "—", None], id_token) == ["12", "-3", "1.50", "x", None, None]
    assert column(["1.0", " 2 ", "-", None, "A.0"], team_type) == ["1", "2", "-", "", "a.0"]
    assert column([" Ivanov   I. ", "NONE", "—", None], person_name) == ["Ivanov I.", None, None, None]
    assert column(["-", " NaN ", "", None, "x", "None"], is_empty) == [True, True, True, True, False, True]


@pytest.mark.parametrize(
    "name, short",
    [
        ('Публичное акционерное общество "Ромашка"', 'ПАО "Ромашка"'),
        ("НЕПУБЛИЧНОЕ АКЦИОНЕРНОЕ ОБЩЕСТВО Лютик", "НАО Лютик"),
        ("«Акционерное общество» Завод", "АО Завод"),
        ("ОООРомашка", "ООО Ромашка"),
        ("ООО«Ромашка»", "ООО «Ромашка»"),
        ("Крестьянское (фермерское) хозяйство Поле", "КФХ Поле"),
        ("Индивидуальный предприниматель. Петров,", "ИП Петров"),
        ("Сельскохозяйственный производственный кооператив Нива", "СПК Нива"),
        ("Просто имя", "Просто имя"),
        ("   ", None),
        (None, None),
    ],
)
def test_client_names(column, name, short):
    assert column([name], client_name) == [short]


def test_dates(column):
    values = ["31.08.2026", "1.9.26", "2026-08-31", "2026-08-31 10:00:00", "13/08/2026", "08/31/2026", "45000", "45000.9", "-", "N/A", "x", "5.1.70"]
    d = dt.date
    want = [
        d(2026, 8, 31), d(2026, 9, 1), d(2026, 8, 31), d(2026, 8, 31), d(2026, 8, 13), d(2026, 8, 31),
        d(2023, 3, 15), d(2023, 3, 15), None, None, None, d(1970, 1, 5),
    ]
    assert column(values, parse_date) == want
    assert [date_value(v) for v in values[:7]] == want[:7]
    assert date_value("x") is None


def test_category(column):
    markers = [("sale", "FOR SALE"), ("work", "IN WORK")]
    got = column(["a sale work.csv", "work.csv", "b.csv"], lambda c: source_category(c, markers, "UNKNOWN"))
    assert got == ["FOR SALE", "IN WORK", "UNKNOWN"]


def test_more_date_forms(column):
    values = ["05-01-2024", "2024.01.05", "20240105", "5 Jan 2024", "5 january 2024", "Jan 5, 2024", "2024-01-05T10:00:00Z", "99999999", "-5", "0"]
    d = dt.date(2024, 1, 5)
    want = [d] * 7 + [None] * 3
    assert column(values, parse_date) == want
    assert [date_value(v) for v in values] == want


def test_safe_values(spark, column):
    assert column(["a\x07b\tc", "nan", "NaT", None, "x" * 40_000], safe_text) == [
        "ab\tc", None, None, None, "x" * 40_000
    ]
    df = spark.createDataFrame([(float("nan"), 1), (float("-inf"), 2), (1.5, 3)], "a double, b int")
    assert [tuple(r) for r in json_safe(df).collect()] == [(None, 1), (None, 2), (1.5, 3)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` Lead ID ` int, other int")
    assert find_column(df.columns, "lead id") == " Lead ID "
    assert project_required(df, {"lead_id": "LEAD ID", "x": "nope"}, ["lead_id"]).columns == ["lead_id"]
    with pytest.raises(ValueError, match="missing columns: x"):
        project_required(df, {"lead_id": "LEAD ID", "x": "nope"}, ["lead_id", "x"])


def plan_of(spark, fn):
    return fn(spark.range(1).selectExpr("string(id) AS v"))._jdf.queryExecution().optimizedPlan().toString()


def test_a_date_is_tried_only_with_patterns_of_its_shape(spark, column):
    plan = plan_of(spark, lambda df: df.select(parse_date(df["v"])))
    assert plan.count("trim(cast(id") == 1 and plan.count("RLIKE") >= 13
    values = ["31.02.1998", "1.2.3.4", "+1.+2.2024", "1.2.12024", "01.02.2024T10:20", "1.2.2024x", "a week", "1 MAY 2024", "45000f"]
    d = dt.date
    assert column(values, parse_date) == [None, None, None, None, d(2024, 2, 1), None, None, d(2024, 5, 1), d(2023, 3, 15)]
    assert column(["1.2.2024"], lambda c: parse_date(c, ["d.M.yyyy[ H]"])) == [d(2024, 2, 1)]


def test_a_tab_number_names_its_text_a_bounded_number_of_times(spark, column):
    plan = plan_of(spark, lambda df: df.select(tab_number(df["v"])))
    assert plan.count("trim(") <= 16
    values = ["0", "00 00", "000000012", "0012345678", "000000000000", "-12.0", "12,5.", "№"]
    assert column(values, tab_number) == ["00000000", "00000000", "00000012", "12345678", "00000000", "00000-12", "00000125", None]


def test_client_names_are_cut_without_a_pattern_compiled_for_every_row(spark, column):
    plan = plan_of(spark, lambda df: df.select(client_name(df["v"])))
    assert "split(" not in plan
    values = ["A\nООО«Б» ЗАОВ", "«общество с ограниченной ответственностью» \"Акционерное Общество.\"Я", "ооо х", ""]
    assert column(values, client_name) == ["A\nООО «Б» ЗАО В", "ООО АО Я", "ооо х", None]
