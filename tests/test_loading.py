import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark.operators.quality import RowCounts, lead_coverage, row_audit
from dwellspark.sources.folders import files_under, layouts, load_folder
from dwellspark.sources.rejects import BROKEN_LINE, accepted, fault_counts, file_counts, quarantine, with_faults
from dwellspark.sources.sinks import read_slices, write_slices, write_split

HEADERS = {"lead_id": ("ID", "Lead"), "report_date": "Date", "days_on_stage": "days", "label": "note"}
NEEDED = ("lead_id", "report_date", "days_on_stage")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "in/a.csv", "ID;Date;days;note\n1;01.02.2024;5;x\n2;;6;y\n")
    put(tmp_path / "in/deep/b.csv", "days ; date;LEAD\n7;2024-02-03;3\n")
    put(tmp_path / "in/deep/er/c.csv", "ID;Date;days;note\n4;45000;8;z\n")
    put(tmp_path / "in/empty.csv", "ID;Date;days;note\n")
    put(tmp_path / "in/readme.txt", "no table\n")
    return str(tmp_path / "in")


def test_a_folder_of_different_headers(spark, folder):
    found = layouts(spark, files_under(spark, folder, "*.csv"), HEADERS, "csv", NEEDED, header=True, sep=";")
    assert sorted(len(x.paths) for x in found) == [1, 3]
    df = load_folder(spark, folder, HEADERS, "csv", NEEDED, "*.csv", sep=";")
    assert rows(df, "source_file", "lead_id", "report_date", "days_on_stage", "label") == [
        ("a.csv", "1", dt.date(2024, 2, 1), 5.0, "x"),
        ("a.csv", "2", None, 6.0, "y"),
        ("b.csv", "3", dt.date(2024, 2, 3), 7.0, None),
        ("c.csv", "4", dt.date(2023, 3, 15), 8.0, "z"),
    ]


def test_a_file_without_a_needed_column_fails_before_its_rows_are_read(spark, folder, tmp_path):
    put(tmp_path / "in/bad.csv", "ID;days\n1;2\n")
    with pytest.raises(ValueError, match=r"bad\.csv: report_date"):
        load_folder(spark, folder, HEADERS, "csv", NEEDED, "*.csv", sep=";")
    with pytest.raises(FileNotFoundError):
        load_folder(spark, folder, HEADERS, "csv", NEEDED, "*.xlsx", sep=";")


def test_types_that_differ_between_files(spark, tmp_path):
    day = dt.date(2024, 5, 6)
    spark.createDataFrame([(1, day, 2.0)], "ID long, Date date, days double").write.parquet(str(tmp_path / "p/a"))
    spark.createDataFrame([("7", "06.05.2024", "n", 3.0)], "days string, Date string, note string, lead double").write.parquet(str(tmp_path / "p/b"))
    spark.createDataFrame([(4, dt.datetime(2024, 5, 6, 9), 5, 1)], "ID int, Date timestamp, Days int, extra int").write.parquet(str(tmp_path / "p/c"))
    df = load_folder(spark, str(tmp_path / "p"), HEADERS, required=NEEDED, pattern="*.parquet")
    assert rows(df, "lead_id", "report_date", "days_on_stage", "label") == [
        ("1", day, 2.0, None), ("3", day, 7.0, "n"), ("4", day, 5.0, None),
    ]


def test_many_files_of_one_header_are_one_scan(spark, tmp_path):
    spark.range(40).selectExpr("id AS ID", "current_date() AS Date", "1D AS days").repartition(20).write.parquet(str(tmp_path / "m"))
    df = load_folder(spark, str(tmp_path / "m"), HEADERS, required=NEEDED, pattern="*.parquet")
    assert df.count() == 40 and df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_rejected_values_are_counted_and_rows_stay(spark, tmp_path):
    put(tmp_path / "r/one.csv", "ID;Date;days\n1;31.02.2024;5\n-;01.02.2024;x\n3;-;nan\n4;01.02.2024\n5;01.02.2024;6;more\n6;01.02.2024;7\n")
    put(tmp_path / "r/two.csv", "days;ID;Date\nmany;7;soon\n")
    checked = load_folder(
        spark, str(tmp_path / "r"), HEADERS, "csv", NEEDED, keep_corrupt=True, normalise=with_faults, sep=";"
    )
    assert rows(fault_counts(checked)) == [
        ("one.csv", "_corrupt_record", BROKEN_LINE, 2),
        ("one.csv", "days_on_stage", "unreadable number", 1),
        ("one.csv", "lead_id", "no lead", 1),
        ("one.csv", "report_date", "unreadable date", 1),
        ("two.csv", "days_on_stage", "unreadable number", 1),
        ("two.csv", "report_date", "unreadable date", 1),
    ]
    assert rows(file_counts(checked)) == [("one.csv", 6, 4), ("two.csv", 1, 1)]
    assert ("x", "unreadable number") in rows(quarantine(checked), "value", "reason")
    assert ("5;01.02.2024;6;more", BROKEN_LINE) in rows(quarantine(checked), "value", "reason")
    table = accepted(checked)
    assert table.count() == 7 and "_faults" not in table.columns and "_corrupt_record" not in table.columns
    assert accepted(checked, [BROKEN_LINE]).count() == 5
    assert accepted(checked, [BROKEN_LINE, "no lead"]).count() == 4


def test_typed_columns_have_no_faults(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1), 2.0, None), (None, None, None, "x")], "lead_id string, report_date date, days_on_stage double, source_file string").withColumn("seq", F.lit(1))
    assert rows(quarantine(with_faults(df)), "column", "reason") == [("lead_id", "no lead")]
    assert fault_counts(with_faults(df.limit(0))).count() == 0
    assert with_faults(df).schema["_faults"].dataType.elementType.names == ["column", "value", "reason"]


def test_counted_steps_equal_an_audit(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    counts = RowCounts()
    kept = counts.watch(counts.watch(df, "all").filter("x > 2"), "large", "x is small").filter("id % 2 = 0")
    counts.watch(kept, "even").write.parquet(str(tmp_path / "o"))
    audit = row_audit(df, df.filter("x > 2"), "x is small").first()
    got = [tuple(r) for r in counts.table(spark).collect()]
    assert got[1] == (1, "large", audit.rows_before, audit.rows_after, audit.dropped, "x is small", False)
    assert got[0] == (0, "all", 1000, 1000, 0, None, False)
    even = spark.read.parquet(str(tmp_path / "o")).count()
    assert got[2] == (2, "even", audit.rows_after, even, audit.rows_after - even, None, True)


def test_coverage_needs_one_exchange(spark):
    a = spark.createDataFrame([(" 1",), ("2",), ("2",), (None,), ("",)], "lead_id string")
    b = spark.createDataFrame([("2",), ("3 ",)], "lead_id string")
    out = lead_coverage(a, b)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert rows(out) == [("1", "missing"), ("3", "extra")]


def times(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_one_territory_is_rewritten_alone(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3)], "tb string, x int")
    write_split(df, str(tmp_path / "t"))
    before = times(tmp_path / "t/tb=A")
    write_split(spark.createDataFrame([("B", 9), ("C", 4)], "tb string, x int"), str(tmp_path / "t"), mode="replace")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "tb", "x") == [("A", 1), ("B", 9), ("C", 4)]
    assert times(tmp_path / "t/tb=A") == before
    with pytest.raises(ValueError, match="folder per value"):
        write_slices(df, df, str(tmp_path / "n"), split=False, mode="replace")


def test_one_slice_is_rewritten_alone_and_the_manifest_names_what_is_there(spark, tmp_path):
    path = str(tmp_path / "s")
    schema = T.StructType.fromDDL("slice_key string, v double, l array<int>")
    df = spark.createDataFrame([("a+b", 1.5, [1]), ("none", float("nan"), None), ("none", 2.0, [2, 3])], schema)
    manifest = spark.createDataFrame([("a+b", 1), ("none", 2)], "slice_key string, record_count long")
    write_slices(df, manifest, path)
    before = times(f"{path}/slices/slice_key=none")
    write_slices(
        spark.createDataFrame([("a+b", 7.0, [])], schema), spark.createDataFrame([("a+b", 5)], manifest.schema), path, mode="replace"
    )
    assert times(f"{path}/slices/slice_key=none") == before
    assert rows(read_slices(spark, path, schema), *schema.names) == [("a+b", 7.0, []), ("none", 2.0, [2, 3]), ("none", None, None)]
    assert rows(read_slices(spark, path, schema, ["a+b"]), "v") == [(7.0,)]
    assert rows(spark.read.json(f"{path}/manifest"), "slice_key", "record_count") == [("a+b", 5), ("none", 2)]


def test_faults_are_found_by_one_reading_of_a_date(spark, tmp_path):
    put(tmp_path / "o/one.csv", "ID;Date;days\n1;31.02.2024;5\n2;01.02.2024;7\n3\n")
    checked = load_folder(
        spark, str(tmp_path / "o"), HEADERS, "csv", NEEDED, keep_corrupt=True, normalise=with_faults, sep=";"
    )
    kept = accepted(checked, [BROKEN_LINE])
    assert sorted(r["lead_id"] for r in kept.collect()) == ["1", "2"]
    for df in (kept, fault_counts(checked), file_counts(checked)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(", d.M.yyyy,") == 1
