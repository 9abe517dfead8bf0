import math
import random
import re
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dwellspark.operators.clipping import clip, clip_bounds
from dwellspark.operators import histogram as H
from dwellspark.operators.norms import active_percentiles, export_columns, norms, stats_nested
from dwellspark.session import materialise


def hist_of(spark, days, **key):
    data = [("g", None if d is None else float(d)) for d in days]
    return H.day_histogram(spark.createDataFrame(data, "g string, days_on_stage double"), ["g"])


def brute(days, p):
    """Value at the rank, by sorting."""
    s = sorted(days)
    count = max(1, math.ceil(p / 100.0 * len(s)))
    t = s[count - 1]
    return t, count, sum(d <= t for d in s)


def test_percentiles_of_ten(spark):
    stats = H.percentile_stats(hist_of(spark, range(10, 101, 10)), ["g"]).first()
    assert (stats.days_on_stage_p20_days, stats.days_on_stage_p20_count) == (20, 2)
    assert (stats.days_on_stage_p20_le_count, stats.days_on_stage_p20_gt_count) == (2, 8)
    assert stats.days_on_stage_p50_days == 50


def test_percentiles_with_ties(spark):
    stats = H.percentile_stats(hist_of(spark, [1, 2, 5, 5, 5, 9]), ["g"]).first()
    assert (stats.days_on_stage_p50_days, stats.days_on_stage_p50_le_count, stats.days_on_stage_p50_gt_count) == (5, 5, 1)


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_against_sorting(spark, seed):
    rng = random.Random(seed)
    groups = {f"g{n}": [rng.randint(-5, 60) for _ in range(n)] for n in (1, 2, 3, 5, 7, 15, 28, 100, 143)}
    df = spark.createDataFrame([(g, float(d)) for g, ds in groups.items() for d in ds], "g string, days_on_stage double")
    ps = (1, 7, 20, 28, 33.3, 50, 80, 99, 100)
    for r in H.percentile_stats(H.day_histogram(df, ["g"]), ["g"], ps, "m").collect():
        for p in ps:
            label = H.percentile_label(p)
            assert (r[f"m_{label}_days"], r[f"m_{label}_count"], r[f"m_{label}_le_count"]) == brute(groups[r.g], p)


def test_rounding_is_half_to_even_and_nulls_are_kept(spark):
    hist = hist_of(spark, [0.5, 1.5, 2.5, None])
    assert rows(hist, "day", "cnt") == [(0, 1), (2, 2), (None, 1)]
    stats = H.percentile_stats(hist_of(spark, [None, None]), ["g"]).first()
    assert (stats.days_on_stage_count, stats.days_on_stage_p80_days, stats.days_on_stage_p80_count) == (0, None, 0)


def kept(spark, days, rules, **options):
    out = clip(hist_of(spark, days), ["g"], rules, **options).filter("kept and day is not null")
    return sorted(d for r in out.collect() for d in [r.day] * r.cnt)


@pytest.mark.parametrize(
    "days, rule, want",
    [
        ([1, 2, 3, 50, 600], {"mode": "range", "min_days": 2, "max_days": 500}, [2, 3, 50]),
        ([1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10], {"mode": "unique_days_trim", "trim_lower_pct": 10, "trim_upper_pct": 10}, [2, 3, 4, 5, 6, 7, 8, 9]),
        ([1, 2, 3, 4, 5, 6, 7, 8, 9], {"mode": "unique_days_trim", "trim_lower_pct": 10, "trim_upper_pct": 10}, [1, 2, 3, 4, 5, 6, 7, 8, 9]),
        ([5, 5, 5, 5, 5, 5], {"mode": "unique_days_trim", "trim_lower_pct": 50, "trim_upper_pct": 50}, [5] * 6),
        ([10, 11, 12, 13, 14, 200], {"mode": "iqr", "iqr_k": 1.5}, [10, 11, 12, 13, 14]),
        ([5, 5, 5, 5, 90], {"mode": "iqr"}, [5, 5, 5, 5, 90]),
        (list(range(1, 21)), {"mode": "percentile_trim", "trim_lower_pct": 5, "trim_upper_pct": 5}, list(range(2, 20))),
        ([1, 2, 600], {"mode": "percentile_trim", "trim_upper_pct": 20}, [1, 2, 600]),
        ([1, 2, 600, 700], {"mode": "range", "max_days": 10}, [1, 2, 600, 700]),
        ([1, 2, 600, 700], {"mode": "range", "max_days": 10, "min_remaining": 2}, [1, 2]),
        ([1, 2, 3, 600], {"mode": "range", "max_days": 10, "scope": {"g": ["other"]}}, [1, 2, 3, 600]),
        ([1, 2, 3, 600], {"mode": "range", "max_days": 10, "scope": {"g": " G "}}, [1, 2, 3]),
        ([1, 2, 3, 600], {"mode": "range", "max_days": 10, "enabled": False}, [1, 2, 3, 600]),
    ],
)
def test_clip_rules(spark, days, rule, want):
    assert kept(spark, days, [rule]) == want


def test_rules_see_what_the_one_before_left(spark):
    rules = [
        {"name": "a", "mode": "range", "max_days": 100},
        {"name": "b", "mode": "unique_days_trim", "trim_lower_pct": 10, "trim_upper_pct": 10},
    ]
    days = list(range(1, 11)) + [500, None]
    bounds = clip_bounds(hist_of(spark, days), ["g"], rules).first()
    assert (bounds.low_day, bounds.high_day) == (2, 9)
    assert (bounds.outlier_before, bounds.outlier_after, bounds.outlier_clipped_total) == (12, 9, 3)
    assert (bounds.outlier_rule_a, bounds.outlier_rule_b) == (1, 2)


def test_unknown_mode_warns_and_keeps(spark):
    with pytest.warns(UserWarning, match="unknown mode"):
        assert kept(spark, [1, 2], [{"mode": "magic"}]) == [1, 2]


def test_managers_at_p80(spark):
    data = [("g", "p", "s", "T", f"M{i}", float(d)) for i, d in enumerate(range(10, 101, 10))]
    data += [("g", "p", "s", "T", "-", 95.0), ("g", "p", "s", "T", "M9", 81.0)]
    df = spark.createDataFrame(data, "product_group string, product string, current_status string, tb string, km string, days_on_stage double")
    table = norms(df)
    assert rows(table, "is_all", "days_on_stage_p80_days", "days_on_stage_p80_km_count") == [(False, 90, 2), (True, 90, 2)]
    clipped = norms(df, clip_rules=[{"mode": "range", "max_days": 94}])
    assert rows(clipped, "days_on_stage_count", "days_on_stage_p80_days", "days_on_stage_p80_km_count") == [(10, 80, 3)] * 2


def test_missing_keys_form_groups(spark):
    df = spark.createDataFrame([(None, "p", "s", None, 5.0), (None, "p", "s", "T", 7.0)], "product_group string, product string, current_status string, tb string, days_on_stage double")
    assert rows(norms(df, km=None), "is_all", "tb", "days_on_stage_max") == [
        (False, "T", 7), (False, None, 5), (True, "все тб", 7)
    ]


def test_second_metric_sees_the_clipped_rows(spark):
    data = [("g", "p", "s", "T", float(d), float(d * 10)) for d in (1, 2, 3, 900)] + [("g", "p", "s", "T", None, 7.0)]
    df = spark.createDataFrame(data, "product_group string, product string, current_status string, tb string, days_on_stage double, days_since_deal double")
    table = norms(df, metrics=("days_on_stage", "days_since_deal"), clip_rules=[{"mode": "range", "max_days": 10}])
    got = table.filter("is_all").first()
    assert (got.days_on_stage_count, got.days_on_stage_max) == (3, 3)
    assert (got.days_since_deal_count, got.days_since_deal_max, got.days_since_deal_min) == (4, 30, 7)
    nested = stats_nested(table, ["tb"], ("days_on_stage", "days_since_deal")).first()
    assert nested.metrics.days_since_deal.percentiles.p80.days == got.days_since_deal_p80_days


def test_same_norms_with_any_partitioning(spark):
    rng = random.Random(5)
    data = [("g", f"p{i % 3}", "s", f"T{i % 2}", f"M{i % 11}", float(rng.randint(0, 90))) for i in range(2000)]
    df = spark.createDataFrame(data, "product_group string, product string, current_status string, tb string, km string, days_on_stage double")
    rules = [{"mode": "unique_days_trim", "trim_lower_pct": 10, "trim_upper_pct": 10}]
    results = []
    for n in ("1", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(norms(df.repartition(int(n)), clip_rules=rules)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_records_behind_norms_are_held_without_an_exchange(spark):
    """Nearly every record has a manager and days of its own; counting them first would write them all once more."""
    data = [("g", f"p{i % 3}", "s", f"T{i % 2}", f"M{i % 11}", float(i % 7), float(i % 5) if i % 4 else None) for i in range(200)]
    df = spark.createDataFrame(data, "product_group string, product string, current_status string, tb string, km string, days_on_stage double, days_since_deal double")
    held = []

    def cut(part):
        held.append(part)
        return materialise(part)

    table = norms(df, metrics=("days_on_stage", "days_since_deal"), cut=cut)
    assert "Exchange" not in held[0]._jdf.queryExecution().executedPlan().toString() and held[0].count() == 200
    # Norms of both metrics are held, so that their size is known where records meet them.
    assert [len(part.columns) < 10 for part in held] == [True, False, False]
    want = {}
    for tb in ("T0", "T1", None):
        for p in ("p0", "p1", "p2"):
            days = sorted(r[6] for r in data if r[1] == p and tb in (r[3], None) and r[6] is not None)
            p80 = days[max(1, math.ceil(0.8 * len(days))) - 1]
            kms = {r[4] for r in data if r[1] == p and tb in (r[3], None) and r[6] is not None and r[6] >= p80}
            want[(tb or "все тб", p)] = (len(days), p80, len(kms))
    shown = ("days_since_deal_count", "days_since_deal_p80_days", "days_since_deal_p80_km_count")
    assert {(r.tb, r["product"]): tuple(r[c] for c in shown) for r in table.collect()} == want


def test_exchanges_go_once_their_rows_are_written(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanges():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = exchanges(), spark.conf.get(key, None)
    held = materialise(spark.range(1000).repartition(7, F.col("id") % 5).groupBy((F.col("id") % 3).alias("k")).count())
    for _ in range(100):
        if not exchanges() - before:
            break
        time.sleep(0.1)
    assert not exchanges() - before
    assert rows(held) == [(0, 334), (1, 333), (2, 333)] and spark.conf.get(key, None) == setting


def test_export_columns():
    assert active_percentiles([{"p": 20}, {"p": 50, "compute": False}, {"p": 80}]) == [20.0, 80.0]
    assert export_columns("m", (20, 80), show_min=False) == [
        "m_max", "m_count", "m_p20_days", "m_p80_le_count", "m_p80_days", "m_p80_gt_count", "m_p80_min",
        "m_p80_max", "m_p80_km_count",
    ]


# --- curves -----------------------------------------------------------------------


def thin(days, limit):
    step = max(1, math.ceil(len(days) / limit)) if len(days) > limit else 1
    out = [(i + 1, days[i]) for i in range(0, len(days), step)]
    return out + ([(len(days), days[-1])] if out[-1][1] != days[-1] else [])


@pytest.mark.parametrize("n, limit", [(5, 10), (10, 10), (11, 10), (95, 10), (400, 7)])
def test_downsample(spark, n, limit):
    rng = random.Random(n)
    days = sorted(rng.randint(0, 30) for _ in range(n))
    got = H.downsample(hist_of(spark, days), ["g"], limit).orderBy("lead_index")
    assert [(r.lead_index, r.days) for r in got.collect()] == thin(days, limit)


def test_rank_curve_splits_long_runs(spark, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 4)
    days = [1] * 10 + [2] * 4 + [9]
    got = H.rank_curve(hist_of(spark, days), ["g"]).orderBy("lead_index")
    assert [(r.lead_index, r.days) for r in got.collect()] == [(i + 1, d) for i, d in enumerate(days)]


def test_ecdf_rounds_half_up(spark):
    got = H.ecdf(hist_of(spark, [1, 1, 2, 3, 4, 4, 4, 8]), ["g"]).orderBy("day")
    assert [(r.day, r.share_pct) for r in got.collect()] == [(1, 25.0), (2, 37.5), (3, 50.0), (4, 87.5), (8, 100.0)]


def test_histogram_buckets(spark):
    days = list(range(0, 100))
    got = H.histogram(hist_of(spark, days), ["g"], 36).orderBy("bucket_start")
    bars = [(r.bucket_start, r.bucket_end, r.leads) for r in got.collect()]
    assert bars[0] == (0, 2, 3) and bars[-1] == (99, 101, 1) and sum(b[2] for b in bars) == 100
    few = H.histogram(hist_of(spark, [3, 3, 9]), ["g"], 36)
    assert rows(few, "bucket_start", "bucket_end", "leads") == [(3, 3, 2), (9, 9, 1)]


def test_aligned_histogram_keeps_zeros(spark):
    df = spark.createDataFrame([("c", "a", 1.0), ("c", "a", 2.0), ("c", "b", 2.0), ("c", "b", 50.0)], "chart string, line string, days_on_stage double")
    hist = H.day_histogram(df, ["chart", "line"])
    assert rows(H.aligned_histogram(hist, ["chart"], ["line"], 24), "line", "start_day", "leads") == [
        ("a", 1, 1), ("a", 2, 1), ("a", 50, 0), ("b", 1, 0), ("b", 2, 1), ("b", 50, 1)
    ]
    wide = rows(H.aligned_histogram(hist, ["chart"], ["line"], 2), "line", "start_day", "end_day", "leads")
    assert wide == [("a", 1, 25, 2), ("a", 26, 50, 0), ("b", 1, 25, 1), ("b", 26, 50, 1)]
    assert rows(H.bucket_of_percentile(hist, ["chart"], ["line"], 80, 2), "line", "percentile_day", "bucket") == [
        ("a", 2, 0), ("b", 50, 1)
    ]


def test_series_cover_all_territories(spark):
    df = spark.createDataFrame(
        [("T1", "g", "p", "s", 1.0, 5.0), ("T2", "g", "p", "s", 1.0, None)],
        "tb string, product_group string, product string, stage_key string, days_on_stage double, days_since_deal double",
    )
    assert rows(H.series_histogram(df), "tb", "metric", "day", "cnt") == [
        ("T1", "days_on_stage", 1, 1), ("T1", "days_since_deal", 5, 1), ("T2", "days_on_stage", 1, 1),
        ("__ALL__", "days_on_stage", 1, 2), ("__ALL__", "days_since_deal", 5, 1),
    ]
