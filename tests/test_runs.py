import os
import re
import sys

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.plans.catalog import ORACLE, QUERIES
from dwellspark.plans.fixtures import contacts, stage_reports, team_members
from dwellspark.functions.output import json_safe
from dwellspark.operators.slices import slices
from dwellspark.operators.tracking import lead_stage_records
from dwellspark.plans.registry import with_ctes
from dwellspark.plans.report import dashboard, report, write, write_dashboard
from dwellspark.plans.settings import CLIP_RULES, FILTERS, ORDER
from dwellspark.sources.rosters import load_contacts
from dwellspark.sources.sinks import read_csv, write_csv, write_split

SF = "/root/testdata/sf0.001"
TOOLS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")
SPEC = {"filters": FILTERS, "filters_order": ORDER, "clip_rules": CLIP_RULES, "status_order": ("AF", "NO")}


def test_report_run(spark, tmp_path):
    tables = report(
        stage_reports(spark, SF), SPEC, team=team_members(spark, SF), contacts=contacts(spark, SF),
        parts=["snapshot", "norms", "manager_summary", "violations", "duration_matrix", "lead_coverage", "funnel"],
    )
    assert rows(tables["norms"]) and tables["lead_coverage"].count() == 0
    assert rows(tables["norms"], "tb", "product", "days_on_stage_p80_days") == sorted(
        [tuple(r) for r in QUERIES["q_norms"](spark, SF).select("tb", "product", "days_on_stage_p80_days").collect()], key=repr
    )
    assert tables["snapshot"].columns[3:6] == ["current_status", "AF", "NO"]
    total = tables["duration_matrix"].agg(F.sum("cnt")).first()[0]
    assert total == tables["snapshot"].count()
    write({"funnel": tables["funnel"]}, str(tmp_path / "csv"), "csv")
    write({"norms": tables["norms"]}, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq/norms")).count() == tables["norms"].count()
    with pytest.raises(ValueError, match="unknown report parts"):
        report(stage_reports(spark, SF), SPEC, ["nonsense"])


def test_dashboard_run(spark, tmp_path):
    spec = {**SPEC, "latest_only": False, "rank_selection": {"label_mode": "all", "efs_flag": 1}, "max_distribution_points": 5}
    tables = dashboard(stage_reports(spark, SF), spec, team=team_members(spark, SF))
    assert rows(tables["manifest"], "slice_key") == [
        (k,) for k in ("from_1998", "from_1998+red_parts", "from_1998+spring_parts", "none", "red_parts", "spring_parts")
    ]
    chosen = {k: tables[k] for k in ("manifest", "pivot_flat", "distribution", "km_by_tb", "top_managers")}
    write_dashboard(chosen, str(tmp_path))
    assert {"slice_key=none", "slice_key=from_1998"} <= set(os.listdir(tmp_path / "pivot/slices"))
    back = spark.read.json(str(tmp_path / "pivot/slices"))
    assert back.filter("slice_key = 'none'").count() == tables["pivot_flat"].filter("slice_key = 'none'").count()
    top = spark.read.json(str(tmp_path / "top_managers"))
    assert "hotspots" in top.columns and top.count() > 0


def test_csv_keeps_every_character(spark, tmp_path):
    texts = ['"', 'a "b" c', "\\", 'a\\"b', "\\\\n", " edge ", "\tt\t", "a\rb", "a\r\nb", "\n", "\r", "a;b", ";", '";"', "'", "#x", '"a', "é\u2028", "x" * 70_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    write_csv(df.repartition(3), str(tmp_path / "q"))
    back = read_csv(spark, str(tmp_path / "q"), df.schema)
    assert [r.t for r in back.orderBy("id").collect()] == texts


def test_csv_and_split(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("tb"), F.lit("a\x07;b").alias("t"))
    write_csv(df.coalesce(1), str(tmp_path / "c"), row_limit=40)
    files = [f for f in os.listdir(tmp_path / "c") if f.startswith("part")]
    back = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "c"))
    assert len(files) == 3 and back.count() == 100 and back.first().t == "a;b"
    write_split(df, str(tmp_path / "s"))
    assert {"tb=0", "tb=1", "tb=2"} <= set(os.listdir(tmp_path / "s"))


def test_contact_file(spark, tmp_path):
    path = tmp_path / "contacts.csv"
    path.write_text("﻿Табельный номер;Почта Альфа;Почта Сигма\n12;a@x;\n012;b@x;s@x\n-;c@x;d@x\n", encoding="utf-8")
    assert rows(load_contacts(spark, [str(path)])) == [("00000012", "a@x", "s@x")]


def test_csv_keeps_long_texts_and_the_format_asked_for(spark, tmp_path):
    df = spark.createDataFrame([("A", "x" * 100_000), ("B", "y")], "tb string, t string")
    write({"filtered_export": df}, str(tmp_path), fmt="csv", split_by="tb")
    back = spark.read.options(sep=";", header=True, maxCharsPerColumn=-1).csv(str(tmp_path / "filtered_export"))
    assert {(r.tb, len(r.t)) for r in back.collect()} == {("A", 100_000), ("B", 1)}
    assert any(f.endswith(".csv") for f in os.listdir(tmp_path / "filtered_export/tb=A"))


def test_many_switches(spark):
    df = spark.range(8).withColumn("c", F.col("id").cast("string"))
    switches = {f"f{i:02d}": {"enabled": False, "column_key": "c", "values": [str(i % 4)], "match": "equals", "value_type": "string"} for i in range(12)}
    out = slices(df, switches)
    assert out.filter("slice_key = 'none'").count() == 8
    assert rows(out.filter("slice_key = 'f01+f05'"), "id") == [(1,)] and out.filter("slice_key = 'f01+f02'").count() == 0
    assert rows(out.filter("slice_key = 'f03+f07+f11'"), "id") == [(3,)]


def test_nested_numbers_are_safe(spark):
    nan = float("nan")
    df = spark.createDataFrame([([(nan, 1)], {"a": nan}), (None, None)], "l array<struct<x:double,y:int>>, m map<string,double>")
    assert [(r.l and [tuple(x) for x in r.l], r.m) for r in json_safe(df).collect()] == [([(None, 1)], {"a": None}), (None, None)]


def test_levels_have_names(spark):
    df = stage_reports(spark, SF)
    assert rows(lead_stage_records(df, "substages")) == rows(lead_stage_records(df, "substage"))
    with pytest.raises(ValueError, match="unknown level"):
        lead_stage_records(df, "substatus")


def test_scan_reads_only_what_is_needed(spark):
    df = QUERIES["q_filter_date"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    number = QUERIES["q_filter_number"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(p_size,25)" in number


LAZY = ["q_funnel", "q_group_funnel", "q_stage_records_lines", "q_lead_snapshot_lines", "q_latest_leaders", "q_team_compose", "q_slice_records", "q_distribution", "q_rank_curve", "q_aligned_histogram"]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loop_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_hot_lead(spark):
    """A lead with about a third of all rows gives the same result with and without adaptive execution."""
    df = stage_reports(spark, SF)
    hot = df.withColumn("lead_id", F.when(F.col("data_entry") == 0, F.lit("HOT")).otherwise(F.col("lead_id")))
    from dwellspark.operators.snapshot import lead_snapshot
    from dwellspark.operators.tracking import lead_stage_records

    want = rows(lead_stage_records(hot)), rows(lead_snapshot(hot))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    got = rows(lead_stage_records(hot.repartition(13))), rows(lead_snapshot(hot.repartition(13)))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == want


@pytest.fixture
def no_broadcast(spark):
    """Joins as over tables that are too large to be sent to every task."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def test_records_of_lines_need_no_exchange_behind_the_joins(spark, no_broadcast):
    """An exchange stays on disk until the query ends: lines pass one per key, wide records none."""
    plan = QUERIES["q_stage_records_lines"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = sorted(re.findall(r"Exchange hashpartitioning\((?:cast\()?(\w+)#", plan))
    assert dealt == sorted([
        "l_orderkey", "l_orderkey", "l_partkey", "l_suppkey", "p_partkey", "s_suppkey", "o_orderkey", "o_custkey",
        "c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey",
    ])  # the first of l_orderkey deals the one file of the test to the cores


def test_hot_order_is_split(spark, tmp_path, no_broadcast):
    for name in ("orders", "part", "supplier", "customer", "nation", "region"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 != 0, F.lit(7)).otherwise(F.col("l_orderkey")).cast("long"))
    hot.write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = rows(QUERIES["q_stage_records_lines"](spark, str(tmp_path)))
    small = {
        "skewJoin.skewedPartitionThresholdInBytes": "1k", "advisoryPartitionSizeInBytes": "1k", "skewJoin.skewedPartitionFactor": "1.5",
        "coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{key}", value)
    try:
        df = QUERIES["q_stage_records_lines"](spark, str(tmp_path))
        assert rows(df) == plain
        joins = re.findall(r"SortMergeJoin\(skew=true\) \[cast\(l_orderkey", df._jdf.queryExecution().executedPlan().toString())
    finally:
        for key in small:
            spark.conf.unset(f"spark.sql.adaptive.{key}")
    assert joins


def test_lines_with_odd_keys_equal_sql(spark, tmp_path):
    """Missing keys, keys that match nothing and keys that are there twice, in every table."""
    odd = {
        "lineitem": ("l_orderkey", "l_partkey", "l_suppkey"), "orders": ("o_orderkey", "o_custkey"), "part": ("p_partkey",),
        "supplier": ("s_suppkey",), "customer": ("c_custkey", "c_nationkey"), "nation": ("n_nationkey", "n_regionkey"),
        "region": ("r_regionkey",),
    }
    number = F.monotonically_increasing_id()
    for name, keys in odd.items():
        df = spark.read.parquet(f"{SF}/{name}.parquet").coalesce(1)
        far = {k: F.when((number + i) % 11 == 3, None).when((number + i) % 13 == 5, F.col(k) + 1_000_000).otherwise(F.col(k)).cast(df.schema[k].dataType) for i, k in enumerate(keys)}
        twice = df.unionByName(df.filter(F.col(keys[0]) % 7 == 2)) if name != "lineitem" else df.limit(400)
        twice.coalesce(1).withColumns(far).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in odd:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    sys.path.insert(0, TOOLS)
    from check import compare

    text, count = compare(spark, con, str(tmp_path), stage_reports, with_ctes("SELECT * FROM sr"))
    assert text is None and count > 400, text
    by_line = ("seq", "tb", "days_since_deal", "efs_flag")
    # A table that no column comes from is not joined, so a key that is there twice in it counts once.
    some = f"SELECT DISTINCT {', '.join(by_line)} FROM sr"
    text, _ = compare(spark, con, str(tmp_path), lambda s, d: stage_reports(s, d, *by_line).distinct(), with_ctes(some))
    assert text is None, text


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


QUICK = [
    "q_load_reports", "q_normalize_reports", "q_ordered_filters", "q_funnel", "q_filter_slices", "q_lead_stage_records",
    "q_lead_snapshot", "q_norms", "q_exceedance", "q_latest_leaders", "q_stuck_items", "q_manager_summary", "q_downsample",
    "q_pivot_all", "q_matrix_by_volume",
]


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, name):
    sys_path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")
    import sys

    sys.path.insert(0, sys_path)
    from check import compare, connect

    text, _ = compare(spark, connect(SF), SF, QUERIES[name], ORACLE[name])
    assert text is None, text
