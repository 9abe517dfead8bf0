import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.operators import distinct as D
from dwellspark.operators import histogram as H
from dwellspark.operators.matrix import duration_matrix
from dwellspark.operators.norms import statistic, stats_variant
from dwellspark.operators.ranking import numbered


def data(n=600):
    rng = random.Random(12)
    return [
        (rng.choice(["A", "B", None]), rng.choice(["x", "y"]), rng.choice([None, *[f"L{i}" for i in range(90)]]), rng.choice(["m", "k", None]))
        for _ in range(n)
    ]


LEVELS = [("tb", "g"), ("g",), ("tb",), ()]


def test_distinct_levels_equal_counting_each(spark):
    held = [*data(), ("C", "z", None, None)]
    df = spark.createDataFrame(held, "tb string, g string, lead string, km string").repartition(3)
    got = D.distinct_rollup(df, LEVELS, ["lead", "km"])
    want = []
    for i, level in enumerate(LEVELS):
        groups = {}
        for tb, g, lead, km in held:
            key = tuple({"tb": tb, "g": g}[k] if k in level else None for k in ("tb", "g"))
            leads, kms = groups.setdefault(key, (set(), set()))
            leads.add(lead)
            kms.add(km)
        want += [(i, *key, len(a - {None}), len(b - {None})) for key, (a, b) in groups.items()]
    assert rows(got, "level", "tb", "g", "n_lead", "n_km") == sorted(want, key=repr)
    empty = D.distinct_rollup(df.limit(0), LEVELS, ["lead"])
    assert rows(empty, "level", "n_lead") == [(3, 0)]


def test_bitmaps_of_many_blocks_and_shared_numbers(spark):
    ids = spark.range(70_000).select((F.col("id") * 3).alias("lead"), (F.col("id") % 2).alias("side"))
    numbers = D.dense_numbers(ids, "lead")
    assert numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()[:] == (1, 70_000, 70_000)
    bits = D.member_bitmaps(ids, ["side"], "lead", numbers)
    assert bits.select(D.BLOCK).distinct().count() == 3
    assert rows(D.members(bits, ["side"])) == [(0, 35_000), (1, 35_000)]
    assert rows(D.members(D.rolled_up(bits, []), [])) == [(70_000,)]


def test_statistics_by_path(spark):
    table = spark.createDataFrame(
        [("A", 1, 9, 4, 7, 2), ("B", None, None, 0, None, 0)],
        "tb string, days_on_stage_min long, days_on_stage_max long, days_on_stage_count long, days_on_stage_p50_days long, days_on_stage_p50_gt_count long",
    )
    held = stats_variant(table, ["tb"], percentiles=[50])
    assert held.schema["metrics"].dataType.simpleString() == "variant"
    picked = held.select(
        "tb", statistic("days_on_stage", "max").alias("a"), statistic("days_on_stage", "days", 50).alias("b"),
        statistic("days_on_stage", "gt_count", 50, kind="double").alias("c"), statistic("days_on_stage", "days", 80).alias("d"),
        statistic("days_since_deal", "min").alias("e"),
    )
    assert rows(picked) == [("A", 9, 7, 2.0, None, None), ("B", None, None, 0.0, None, None)]


def test_places_within_groups(spark):
    df = spark.createDataFrame([(g, i * 37 % 101) for g in ("a", "b") for i in range(100)], "g string, x int").repartition(5)
    got = numbered(df, [F.desc("x")], "place", within="g")
    for g in ("a", "b"):
        xs = [r.x for r in got.filter(F.col("g") == g).orderBy("place").collect()]
        assert xs == sorted(xs, reverse=True)
    assert rows(got.groupBy("g").agg(F.min("place"), F.max("place"), F.count_distinct("place"))) == [("a", 1, 100, 100), ("b", 1, 100, 100)]
    assert rows(numbered(df.limit(0), [F.col("x")], "place")) == []


@pytest.mark.parametrize("layout", ["by_volume", "alpha_days", "group_alpha_product_volume"])
def test_layouts_of_a_matrix(spark, layout):
    held = [("b", "q", 1, 5), ("B", "p", 2, 9), ("a", "z", 1, 1), ("a", "y", 3, 4), ("", "y", 3, 4)]
    counts = spark.createDataFrame(held, "product_group string, product string, day long, cnt long")
    got = duration_matrix(counts, layout=layout)
    names = [r.product_group + r.product for r in got.orderBy("row_position").collect()]
    assert names == {
        "by_volume": ["Bp", "bq", "y", "ay", "az"],
        "alpha_days": ["y", "ay", "az", "Bp", "bq"],
        "group_alpha_product_volume": ["y", "ay", "az", "Bp", "bq"],
    }[layout]
    days = dict(rows(got, "day", "day_position"))
    assert days == ({2: 1, 3: 2, 1: 3} if layout == "by_volume" else {1: 1, 2: 2, 3: 3})


def test_one_chart_of_all_series(spark):
    hist = spark.createDataFrame([("p", 1, 2), ("p", 4, 1), ("q", 4, 5), ("r", None, 3)], "line string, day long, cnt long")
    got = rows(H.aligned_histogram(hist, [], ["line"], 24), "line", "bucket", "start_day", "end_day", "leads")
    assert got == sorted((line, i, d, d, n) for line, ns in (("p", (2, 1)), ("q", (0, 5)), ("r", (0, 0))) for i, (d, n) in enumerate(zip((1, 4), ns)))
    wide = rows(H.aligned_histogram(hist, [], ["line"], 1), "line", "start_day", "end_day", "leads")
    assert wide == [("p", 1, 4, 3), ("q", 1, 4, 5), ("r", 1, 4, 0)]
    assert rows(H.bucket_defs(hist, [], 24), "bucket", "start_day") == [(0, 1), (1, 4)]
    assert rows(H.bucket_of_percentile(hist, [], ["line"], 80), "line", "bucket") == [("p", 1), ("q", 1)]


def _counted(spark, rows, schema):
    """A frame of these rows, and how many of them were read."""
    read = spark.sparkContext.accumulator(0)

    def note(row):
        read.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(note), schema), read


def test_levels_of_distinct_counts_read_the_rows_once(spark):
    from dwellspark.operators.distinct import distinct_rollup

    rows = [("a", "p", "1", "k"), ("a", "q", "1", None), (None, "q", "2", "k"), ("b", "p", None, "m")]
    df, read = _counted(spark, rows, "tb string, product string, lead_id string, km string")
    got = distinct_rollup(df, (("tb", "product"), ("tb",), ()), ["lead_id", "km"]).collect()
    assert read.value == len(rows)
    assert sorted(tuple(r)[3:] for r in got if r["level"] == 1) == [(0, 1), (1, 1), (1, 1)]
    assert [tuple(r)[3:] for r in got if r["level"] == 2] == [(2, 2)]


def test_teams_of_ranked_managers_are_read_once(spark, monkeypatch):
    from dwellspark.plans import queries_managers as Q

    compose, held = Q.run_team, []

    def counted(detail, session, sf):
        team = compose(detail, session, sf)
        rows = team.collect()
        df, read = _counted(session, rows, team.schema)
        held.append((len(rows), read))
        return df

    monkeypatch.setattr(Q, "run_team", counted)
    got = Q.run_ranked(spark, "/root/testdata/sf0.001").collect()
    assert got and [read.value for _, read in held] == [n for n, _ in held]
