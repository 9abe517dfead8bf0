import datetime as dt
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.operators.filters import (
    excluded_stages,
    filter_spec,
    filters_order,
    filter_specs,
    infer_value_type,
    ordered_filters,
    terminal_rows_out,
)
from dwellspark.operators.funnel import audit_names, funnel, group_funnel
from dwellspark.operators.slices import combine, default_slice_key, normalise_choice, slice_key, sliced_records, slices
from dwellspark.operators.tracking import lead_stage_records


@pytest.mark.parametrize(
    "raw, want",
    [
        ({"value": 0}, ("include", "equals", "any", "number", (0,))),
        ({"contains_all": ["a", "b"]}, ("include", "contains", "all", "string", ("a", "b"))),
        ({"contains_any": ["a"]}, ("include", "contains", "any", "string", ("a",))),
        ({"exclude_contains": "x", "filter_mode": "exclude"}, ("exclude", "contains", "any", "string", ("x",))),
        ({"exclude_equals": "x"}, ("exclude", "equals", "any", "string", ("x",))),
        ({"values": ["01.02.2026"], "match": ">="}, ("include", "gte", "any", "date", ("01.02.2026",))),
        ({"values": [], "match": "starts-with"}, ("include", "starts_with", "any", "string", ())),
        ({"values": ["1"], "match": "nonsense", "values_mode": "both"}, ("include", "equals", "any", "number", ("1",))),
        ({"match": "max", "column_key": "report_date"}, ("include", "max", "any", "date", ())),
        ({"match": "min", "column_key": "efs_flag"}, ("include", "min", "any", "number", ())),
        ({"match": "max", "column_key": "label"}, ("include", "max", "any", "string", ())),
    ],
)
def test_specs(raw, want):
    s = filter_spec("f", raw)
    assert (s.action, s.match, s.values_mode, s.value_type, s.values) == want


def test_value_types():
    assert [infer_value_type(v) for v in (["2"], [2.5], ["x"], ["2026-01-05"], ["1,5"], [None, ""], [True])] == [
        "number", "number", "string", "date", "number", "string", "number"
    ]


@pytest.fixture(scope="module")
def sample(spark):
    data = [
        ("a", "Alpha one", "01.02.2026", "1", "-"),
        ("b", "beta two", "05.02.2026", "2.5", "Refused"),
        ("c", None, None, "x", None),
        ("d", "ALPHA two ", "2026-02-10", "10", "Open"),
    ]
    return spark.createDataFrame(data, "id string, t string, d string, n string, s string")


@pytest.mark.parametrize(
    "flt, ids",
    [
        ({"column_key": "t", "values": ["alpha two"]}, "d"),
        ({"column_key": "t", "values": ["alpha"], "match": "contains"}, "ad"),
        ({"column_key": "t", "values": ["ALPHA"], "match": "contains", "case_sensitive": True, "value_type": "string"}, "d"),
        ({"column_key": "t", "values": ["two"], "match": "ends_with"}, "bd"),
        ({"column_key": "t", "values": ["alpha", "two"], "match": "contains", "values_mode": "all"}, "d"),
        ({"column_key": "n", "values": [2], "match": "gt"}, "bd"),
        ({"column_key": "n", "values": [2.5, 1]}, "ab"),
        ({"column_key": "d", "values": ["05.02.2026"], "match": "gte"}, "bd"),
        ({"column_key": "d", "values": [dt.date(2026, 2, 1)], "value_type": "date"}, "a"),
        ({"column_key": "d", "match": "max", "value_type": "date"}, "d"),
        ({"column_key": "n", "match": "min", "value_type": "number"}, "a"),
        ({"column_key": "t", "match": "min", "value_type": "string"}, "d"),
        ({"column_key": "t", "values": []}, "abcd"),
        ({"column_key": "n", "values": ["word"], "value_type": "number"}, "abcd"),
        ({"column_key": "nope", "values": ["x"]}, "abcd"),
        ({"column_key": "s", "exclude_contains": "refus"}, "acd"),
        ({"column_key": "s", "action": "exclude", "values": ["-", "open"]}, "abc"),
        ({"column_key": "t", "column_keys": ["s"], "values": ["o"], "match": "contains"}, "abd"),
        ({"column_key": "t", "match": "max", "value_type": "number"}, ""),
    ],
)
def test_matches(sample, flt, ids):
    got = ordered_filters(sample, {"f": {"enabled": True, **flt}})
    assert "".join(sorted(r.id for r in got.collect())) == ids


def test_empty_stages_survive_excludes(spark):
    stages = ["-", "", "nan", "None", None, "   ", "Refused", "Open"]
    df = spark.createDataFrame([(s,) for s in stages], "deal_stage string")
    out = terminal_rows_out(df, {"x": {"enabled": True, "column_key": "deal_stage", "exclude_contains": "refused"}})
    assert out.count() == 7


def test_extreme_sees_the_remainder(spark):
    df = spark.createDataFrame(
        [(1, "01.08.2026", "x"), (1, "15.08.2026", "y"), (0, "31.08.2026", "x"), (1, "15.08.2026", "x")],
        "efs_flag int, report_date string, label string",
    )
    filters = {
        "label": {"enabled": True, "column_key": "label", "contains": "x"},
        "newest": {"enabled": True, "column_key": "report_date", "match": "max"},
        "efs": {"enabled": True, "column_key": "efs_flag", "value": 1},
    }
    assert ordered_filters(df, filters, ["efs", "newest", "label"]).count() == 1
    assert ordered_filters(df, filters, ["newest", "efs"]).count() == 0


def test_order_and_names():
    filters = {
        "z": {"enabled": True, "column_key": "current_status", "exclude_equals": "OLD", "html_slice": False},
        "a": {"enabled": True, "column_key": "x", "value": 1},
        "b": {"enabled": True, "column_key": "deal_stage", "exclude_equals": "END", "html_slice": False},
    }
    assert filters_order(filter_specs(filters)) == ["a", "b", "z"]
    assert filters_order(filter_specs(filters), ["z", "z", ""]) == ["z", "a", "b"]
    assert excluded_stages(filters) == ["OLD", "END"]
    assert audit_names(filters) == ["filter_before", "filter_dropped_a", "filter_dropped_b", "filter_dropped_z", "filter_after"]


SWITCHES = {
    "one": {"column_key": "x", "values": [1], "default_active": True},
    "two": {"column_key": "x", "values": [2], "exclusive_group": "g"},
    "three": {"column_key": "x", "values": [3], "exclusive_group": "g"},
    "four": {"column_key": "y", "values": [4]},
}


def test_combinations():
    combos = combine(SWITCHES)
    assert len(combos) == 12 and [] in combos
    assert not any({"two", "three"} <= set(c) for c in combos)
    assert slice_key(["two", "one"]) == "one+two" and default_slice_key(SWITCHES) == "one"
    assert normalise_choice(SWITCHES, ["two", "one", "three"]) == ["one", "three"]
    assert len(combine({str(i): {"column_key": "x", "values": [i]} for i in range(11)})) == 2**11


def test_slices_equal_separate_runs(spark):
    df = spark.createDataFrame([(i, i % 4, i % 5) for i in range(40)], "id int, x int, y int")
    tagged = slices(df, SWITCHES)
    for combo in combine(SWITCHES):
        one = ordered_filters(df, {n: {**SWITCHES[n], "enabled": True} for n in combo})
        part = tagged.filter(F.col("slice_key") == slice_key(combo))
        assert rows(part, "id") == rows(one, "id"), combo


EXTREMES = {
    "low": {"column_key": "x", "match": "less", "values": [3], "value_type": "number"},
    "top": {"column_key": "y", "match": "max", "value_type": "number"},
    "odd": {"column_key": "z", "match": "equals", "values": [1], "value_type": "number"},
    "least": {"column_keys": ["x", "z"], "match": "min", "value_type": "number"},
    "out": {"column_key": "w", "action": "exclude", "match": "max", "value_type": "number"},
    "absent": {"column_key": "nowhere", "match": "max", "value_type": "number"},
}


def test_slices_with_extremes_equal_separate_runs(spark):
    df = spark.createDataFrame([(i, i % 4, i * 7 % 5, i % 3, i % 6) for i in range(60)], "id int, x int, y int, z int, w int")
    tagged = slices(df, EXTREMES).select("id", "slice_key").collect()
    found = {slice_key(c): sorted(r.id for r in tagged if r.slice_key == slice_key(c)) for c in combine(EXTREMES)}
    assert len(found) == 64
    for combo in combine(EXTREMES):
        one = ordered_filters(df, {n: {**EXTREMES[n], "enabled": True} for n in combo}, filters_order(filter_specs(EXTREMES)))
        want = [] if "absent" in combo else sorted(r.id for r in one.collect())
        assert found[slice_key(combo)] == want, combo


def test_extremes_of_all_combinations_are_one_pass(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 7 AS x", "id % 5 AS y", "id % 3 AS z").write.parquet(str(tmp_path / "t"))
    three = {n: EXTREMES[n] for n in ("low", "odd", "top")}
    tagged = slices(spark.read.parquet(str(tmp_path / "t")), three)
    assert len(combine(three)) == 8
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    # One subquery has the extremes of all combinations, wherever they are used.
    assert len(set(re.findall(r"Subquery subquery#(\d+)", plan))) == 1, plan


@pytest.mark.parametrize("agg", ["max", "min", "sum", "mean", "median", "first", "last"])
def test_records_on_masks_equal_records_of_slices(spark, agg):
    rng = random.Random(agg)
    data = [
        (i, f"L{rng.randrange(3)}", "g", rng.choice(["p", None]), "t", rng.choice(["s", "u"]), rng.choice(["d", "-", "e"]),
         dt.date(2024, 1, rng.randrange(1, 4)), rng.choice([None, 1.0, 2.0, 5.0]), rng.choice([None, 3.0]), rng.choice([None, "k", "m"]),
         rng.randrange(4), rng.randrange(5))
        for i in range(400)
    ]
    df = spark.createDataFrame(
        data,
        "seq int, lead_id string, product_group string, product string, tb string, current_status string, deal_stage string, "
        "report_date date, days_on_stage double, days_since_deal double, km string, x int, y int",
    )
    for filters in (SWITCHES, {n: EXTREMES[n] for n in ("low", "top")}):
        for mode in ("group_product", "group_only"):
            got = sliced_records(df, filters, "both", mode, agg)
            want = lead_stage_records(slices(df, filters), "both", mode, agg, tags=["slice_key"])
            assert rows(got, *want.columns) == rows(want)


def test_no_exchange_sees_repeated_rows(spark):
    plan = slices_plan(spark)
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    # The generator that repeats states lies above both exchanges.
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning")


def slices_plan(spark):
    df = spark.createDataFrame(
        [(1, "L", "g", "p", "t", "s", "d", dt.date(2024, 1, 1), 1.0, 2, 3)],
        "seq int, lead_id string, product_group string, product string, tb string, current_status string, deal_stage string, "
        "report_date date, days_on_stage double, x int, y int",
    )
    return sliced_records(df, SWITCHES)._jdf.queryExecution().executedPlan().toString()


def test_funnel(spark):
    df = spark.createDataFrame(
        [("L1", 1, "t"), ("L1", 2, "t"), ("L2", 3, "u"), (" ", 4, "u"), (None, 5, "u")],
        "lead_id string, x int, tb string",
    ).withColumns({"product_group": F.lit("g"), "product": F.lit("p"), "current_status": F.lit("s")})
    filters = {
        "low": {"enabled": True, "column_key": "x", "values": [4], "match": "lte"},
        "top": {"enabled": True, "column_key": "x", "match": "max", "value_type": "number"},
    }
    got = rows(funnel(df, filters), "step", "before_rows", "after_rows", "before_leads", "after_leads", "dropped_leads")
    assert got == [(1, 5, 4, 2, 2, 0), (2, 4, 1, 2, 0, 2)]
    audit = group_funnel(df, {"low": {**filters["low"], "values": [2]}})
    assert rows(audit, "is_all", "tb", "filter_before", "filter_dropped_low", "filter_after") == [
        (False, "t", 1, 0, 1), (False, "u", 1, 1, 0), (True, "все тб", 2, 1, 1)
    ]


def test_funnel_equals_step_by_step(spark):
    df = spark.createDataFrame(
        [(f"L{i % 37}", i % 3, i % 7, "T") for i in range(400)], "lead_id string, x int, y int, tb string"
    )
    filters = {
        "a": {"enabled": True, "column_key": "x", "values": [0, 1], "value_type": "number"},
        "b": {"enabled": True, "column_key": "y", "action": "exclude", "values": [3]},
        "c": {"enabled": True, "column_key": "y", "values": [5], "match": "lt"},
    }
    left, steps = df, []
    for name in ("a", "c", "b"):
        after = ordered_filters(left, {name: filters[name]})
        steps.append((left.count(), after.count(), left.select("lead_id").distinct().count(), after.select("lead_id").distinct().count()))
        left = after
    got = funnel(df, filters, ["a", "c", "b"]).orderBy("step")
    assert [tuple(r) for r in got.select("before_rows", "after_rows", "before_leads", "after_leads").collect()] == steps
