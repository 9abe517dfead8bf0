"""The day histogram and everything that can be read off it.

A group's histogram has at most as many rows as it has distinct days, however
many leads it counts. Percentiles, summaries, curves and buckets are windows
over it, so no group of leads is ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import whole_days

CHUNK = 65_536


def percentile_label(p: float) -> str:
    return f"p{int(p)}" if float(p).is_integer() else "p" + str(p).replace(".", "_")


def day_histogram(
    records: DataFrame, keys: Sequence[str], metric: str = "days_on_stage", weight: str | None = None
) -> DataFrame:
    """Leads per group and whole day; days that are missing form a bucket of their own."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return records.groupBy(*keys, whole_days(F.col(metric)).alias("day")).agg(
        count.cast("long").alias("cnt")
    )


def merge_series(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The histogram on fewer keys: the union of the series."""
    return hist.groupBy(*keys, "day").agg(F.sum("cnt").alias("cnt"))


def series_histogram(
    records: DataFrame,
    keys: Sequence[str] = ("product_group", "product", "stage_key"),
    metrics: Sequence[str] = ("days_on_stage", "days_since_deal"),
    tb: str = "tb",
    all_label: str = K.ALL_SERIES,
) -> DataFrame:
    """Histograms of all series of the dashboard: per metric, by territory and over all of them.

    Records are counted once; the overall series are the sum of the territories.
    """
    values = F.array(
        *[F.struct(F.lit(m).alias("metric"), whole_days(F.col(m)).alias("day")) for m in metrics]
    )
    long = records.select(tb, *keys, F.inline(values)).filter(F.col("day").isNotNull())
    by_tb = long.groupBy(tb, *keys, "metric", "day").agg(F.count(F.lit(1)).alias("cnt"))
    labels = F.array(F.col(tb), F.lit(all_label))
    both = by_tb.withColumn(tb, F.explode(labels))
    return both.groupBy(tb, *keys, "metric", "day").agg(F.sum("cnt").alias("cnt"))


def cumulate(hist: DataFrame, keys: Sequence[str], cnt: str = "cnt") -> DataFrame:
    """Add `n`, the leads with known days of the group, and `cum`, those up to the day."""
    by = ", ".join(f"`{k}`" for k in keys)
    known = f"sum(CASE WHEN day IS NOT NULL THEN {cnt} ELSE 0L END)"
    return hist.selectExpr(
        "*",
        f"{known} OVER (PARTITION BY {by}) AS n",
        f"{known} OVER (PARTITION BY {by} ORDER BY day NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cum",
    )


def percentile_stats(
    hist: DataFrame,
    keys: Sequence[str],
    percentiles: Sequence[float] = (20, 50, 80),
    prefix: str = "days_on_stage",
    extra: Sequence[Column] = (),
    cnt: str = "cnt",
) -> DataFrame:
    """Minimum, maximum, count and empirical percentiles of every group.

    A percentile is the value at its rank, not an interpolation. Each comes with
    the size, minimum and maximum of the lower share and the leads at or below
    and above it. `extra` are further aggregates of the histogram rows.
    """
    # Rows with no lead in them (a clipped day) take no part.
    here = f"day IS NOT NULL AND {cnt} > 0"
    aggs = [
        f"min(day) FILTER (WHERE {here}) AS _min",
        f"max(day) FILTER (WHERE {here}) AS _max",
        "max(n) AS _n",
        f"coalesce(min(cum) FILTER (WHERE {here}), 0) AS _min_le",
    ]
    columns = [
        f"_min AS {prefix}_min",
        f"_max AS {prefix}_max",
        f"_n AS {prefix}_count",
        f"_min_le AS {prefix}_min_le_count",
        f"_n - _min_le AS {prefix}_min_gt_count",
        f"_n AS {prefix}_max_le_count",
        f"0L AS {prefix}_max_gt_count",
    ]
    for p in percentiles:
        name = f"{prefix}_{percentile_label(p)}"
        # The upper end of the lower share of n sorted values.
        rank = f"greatest(1, ceil({p / 100.0!r}D * n))"
        at = f"_{percentile_label(p)}"
        aggs += [
            f"min(day) FILTER (WHERE {here} AND cum >= {rank}) AS {at}_day",
            f"coalesce(min(cum) FILTER (WHERE {here} AND cum >= {rank}), 0) AS {at}_le",
        ]
        columns += [
            f"{at}_day AS {name}_days",
            f"CASE WHEN _n > 0 THEN {rank.replace('* n', '* _n')} ELSE 0L END AS {name}_count",
            f"_min AS {name}_min",
            f"{at}_day AS {name}_max",
            f"{at}_le AS {name}_le_count",
            f"_n - {at}_le AS {name}_gt_count",
        ]
    stats = cumulate(hist, keys, cnt).groupBy(*keys).agg(*[F.expr(a) for a in aggs], *extra)
    inner = len(keys) + len(aggs)
    return stats.selectExpr(*[f"`{k}`" for k in keys], *columns, *[f"`{c}`" for c in stats.columns[inner:]])


def _known(hist: DataFrame) -> DataFrame:
    return hist.filter(F.col("day").isNotNull())


def distribution(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted days of every series in run lengths: lead numbers first_lead..last_lead have `day`."""
    cum = cumulate(_known(hist), keys)
    return cum.select(
        *keys,
        "day",
        "cnt",
        (F.col("cum") - F.col("cnt") + 1).alias("first_lead"),
        F.col("cum").alias("last_lead"),
        F.col("n").alias("total_leads"),
    )


def rank_curve(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per lead of a series: its number by days, and the days.

    Runs are cut into chunks and spread before they are written out, so that a
    day with very many leads does not end in one task.
    """
    runs = distribution(hist, keys)
    last = F.floor((F.col("cnt") - 1) / F.lit(CHUNK))
    chunks = runs.select(*keys, "day", "first_lead", "last_lead", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    spread = chunks.repartition(*[F.col(k) for k in keys], F.col("day"), F.col("chunk"))
    start = F.col("first_lead") + F.col("chunk") * CHUNK
    stop = F.least(F.col("last_lead"), start + (CHUNK - 1))
    return spread.select(*keys, F.explode(F.sequence(start, stop)).alias("lead_index"), F.col("day").alias("days"))


def downsample(hist: DataFrame, keys: Sequence[str], max_points: int = 800) -> DataFrame:
    """At most about `max_points` points per series at even steps; the largest day is kept."""
    runs = distribution(hist, keys)
    n = F.col("total_leads")
    step = F.greatest(F.lit(1), F.ceil(n / F.lit(max_points))) if max_points > 0 else F.lit(1)
    stepped = runs.withColumn("step", step.cast("long"))
    # Positions 1, 1 + step, 1 + 2 step, ... that fall into the run.
    low = F.ceil((F.col("first_lead") - 1) / F.col("step"))
    high = F.floor((F.col("last_lead") - 1) / F.col("step"))
    hits = F.when(low <= high, F.transform(F.sequence(low, high), lambda k: k * F.col("step") + 1))
    # The last lead is added when the last step stopped at a smaller day.
    final = F.floor((n - 1) / F.col("step")) * F.col("step") + 1
    tail = F.when((F.col("last_lead") == n) & (final < F.col("first_lead")), F.array(n))
    empty = F.array().cast("array<bigint>")
    points = F.concat(F.coalesce(hits, empty), F.coalesce(tail, empty))
    return stepped.select(*keys, F.explode(points).alias("lead_index"), F.col("day").alias("days"))


def ecdf(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of leads at or below each day, in percent with one decimal."""
    share = F.floor(F.col("cum") / F.col("n") * 1000 + 0.5) / 10
    return cumulate(_known(hist), keys).select(*keys, "day", share.alias("share_pct"))


def _bucket_frame(hist: DataFrame, keys: Sequence[str], max_bars: int) -> DataFrame:
    """Smallest and largest day, number of distinct days and bucket width of every group."""
    span = F.col("max_day") - F.col("min_day") + 1
    return (
        # Once per day first: a chart has many series on the same days.
        _known(hist)
        .select(*keys, "day")
        .distinct()
        .groupBy(*keys)
        .agg(
            F.min("day").alias("min_day"),
            F.max("day").alias("max_day"),
            F.count(F.lit(1)).alias("distinct_days"),
        )
        .withColumn("size", F.greatest(F.lit(1), F.ceil(span / F.lit(max_bars))).cast("long"))
        .withColumn("per_day", F.col("distinct_days") <= max_bars)
    )


def histogram(hist: DataFrame, keys: Sequence[str], max_bars: int = 36) -> DataFrame:
    """Bars of every series: one per day if these are few, else buckets of equal width."""
    group = Window.partitionBy(*keys)
    low, high = F.min("day").over(group), F.max("day").over(group)
    framed = (
        _known(hist)
        .withColumns({"min_day": low, "max_day": high, "distinct_days": F.count(F.lit(1)).over(group)})
        .withColumn(
            "size",
            F.when(F.col("distinct_days") <= max_bars, F.lit(1)).otherwise(
                F.greatest(F.lit(1), F.ceil((F.col("max_day") - F.col("min_day") + 1) / F.lit(max_bars)))
            ).cast("long"),
        )
    )
    index = F.floor((F.col("day") - F.col("min_day")) / F.col("size"))
    start = (F.col("min_day") + index * F.col("size")).alias("bucket_start")
    return (
        framed.groupBy(*keys, "size", start)
        .agg(F.sum("cnt").alias("leads"))
        .select(
            *keys,
            "bucket_start",
            (F.col("bucket_start") + F.col("size") - 1).alias("bucket_end"),
            F.col("size").alias("bucket_size"),
            (F.col("bucket_start") + F.col("size") / 2 - 0.5).alias("x"),
            "leads",
        )
    )


def bucket_defs(hist: DataFrame, chart: Sequence[str], max_bars: int = 24) -> DataFrame:
    """Buckets shared by all series of a chart, numbered from 0."""
    if not chart:
        return bucket_defs(hist.withColumn("_all", F.lit(0)), ["_all"], max_bars).drop("_all")
    frame = _bucket_frame(hist, chart, max_bars)
    wide = frame.filter(~F.col("per_day")).select(
        *chart,
        F.posexplode(F.sequence("min_day", "max_day", "size")).alias("bucket", "start_day"),
        "size",
        "max_day",
    )
    wide = wide.select(
        *chart,
        "bucket",
        "start_day",
        F.least(F.col("start_day") + F.col("size") - 1, F.col("max_day")).alias("end_day"),
    )
    narrow_keys = frame.filter("per_day").select(*chart)
    days = _known(hist).select(*chart, "day").distinct()
    on = [days[c].eqNullSafe(narrow_keys[c]) for c in chart]
    narrow = days.join(narrow_keys, on, "left_semi")
    number = F.row_number().over(Window.partitionBy(*chart).orderBy("day")) - 1
    narrow = narrow.select(*chart, number.alias("bucket"), F.col("day").alias("start_day"), F.col("day").alias("end_day"))
    return wide.unionByName(narrow)


def aligned_histogram(
    hist: DataFrame, chart: Sequence[str], series: Sequence[str], max_bars: int = 24
) -> DataFrame:
    """Leads per common bucket and series of a chart; empty buckets count zero.

    The histogram is read once: windows over a chart give its ends, its distinct days and the bucket of
    every row. What follows has at most `max_bars` entries per series.
    """
    if not chart:
        return aligned_histogram(hist.withColumn("_all", F.lit(0)), ["_all"], series, max_bars).drop("_all")
    by = Window.partitionBy(*chart)
    known = F.col("day").isNotNull()
    rank = F.dense_rank().over(by.orderBy(F.col("day").asc_nulls_last()))
    framed = hist.withColumns({"_low": F.min("day").over(by), "_high": F.max("day").over(by), "_rank": rank})
    framed = framed.withColumn("_days", F.max(F.when(known, F.col("_rank"))).over(by))
    span = F.col("_high") - F.col("_low") + 1
    width = F.greatest(F.lit(1), F.ceil(span / F.lit(max_bars))).cast("long")
    # Width 0: every day is a bucket of its own.
    framed = framed.withColumn("_size", F.when(F.col("_days") <= max_bars, F.lit(0).cast("long")).otherwise(width))
    wide = F.col("_low") + F.floor((F.col("day") - F.col("_low")) / F.col("_size")) * F.col("_size")
    start = F.when(F.col("_size") == 0, F.col("day")).otherwise(wide)
    frame = ["_low", "_high", "_size"]
    counts = framed.groupBy(*chart, *series, *frame, start.alias("_start")).agg(F.sum("cnt").alias("cnt"))
    pairs = F.collect_list(F.when(F.col("_start").isNotNull(), F.struct("_start", "cnt")))
    held = counts.groupBy(*chart, *series, *frame).agg(F.map_from_entries(pairs).alias("_counts"))
    days = counts.groupBy(*chart).agg(F.array_sort(F.collect_set(F.when(F.col("_size") == 0, F.col("_start")))).alias("_starts"))
    right = days.select(*[F.col(c).alias(f"d_{c}") for c in chart], "_starts")
    joined = held.join(right, [held[c].eqNullSafe(right[f"d_{c}"]) for c in chart], "left")
    steps = F.when(F.col("_size") > 0, F.sequence("_low", "_high", F.greatest("_size", F.lit(1))))
    starts = F.coalesce(steps, F.col("_starts"))
    out = joined.select(*chart, *series, *frame, "_counts", F.posexplode(starts).alias("bucket", "start_day"))
    end = F.when(F.col("_size") == 0, F.col("start_day")).otherwise(
        F.least(F.col("start_day") + F.col("_size") - 1, F.col("_high"))
    )
    leads = F.coalesce(F.try_element_at("_counts", F.col("start_day")), F.lit(0)).cast("long")
    return out.select(*chart, *series, "bucket", "start_day", end.alias("end_day"), leads.alias("leads"))


def bucket_of_percentile(
    hist: DataFrame, chart: Sequence[str], series: Sequence[str], p: float = 80, max_bars: int = 24
) -> DataFrame:
    """Number of the common bucket that holds the percentile of each series."""
    if not chart:
        return bucket_of_percentile(hist.withColumn("_all", F.lit(0)), ["_all"], series, p, max_bars).drop("_all")
    keys = [*chart, *series]
    day = f"days_{percentile_label(p)}_days"
    stats = percentile_stats(hist, keys, [p], "days").select(*keys, F.col(day).alias("day"))
    stats = stats.filter(F.col("day").isNotNull()).withColumn("cnt", F.lit(0).cast("long"))
    frame = _bucket_frame(hist, chart, max_bars)
    f = frame.select(*[F.col(c).alias(f"f_{c}") for c in chart], "min_day", "size", "per_day")
    buckets = bucket_defs(hist, chart, max_bars)
    b = buckets.select(*[F.col(c).alias(f"b_{c}") for c in chart], "bucket", F.col("start_day").alias("b_start"))
    placed = stats.join(f, [stats[c].eqNullSafe(f[f"f_{c}"]) for c in chart])
    start = F.when(F.col("per_day"), F.col("day")).otherwise(
        F.col("min_day") + F.floor((F.col("day") - F.col("min_day")) / F.col("size")) * F.col("size")
    )
    placed = placed.withColumn("start_day", start)
    on = [placed[c].eqNullSafe(b[f"b_{c}"]) for c in chart] + [F.col("start_day") == F.col("b_start")]
    return placed.join(b, on).select(*keys, F.col("day").alias("percentile_day"), "bucket")


def top_series(
    hist: DataFrame, chart: Sequence[str], series: Sequence[str], limit: int
) -> DataFrame:
    """The most populated series of each chart, with their position."""
    totals = _known(hist).groupBy(*chart, *series).agg(F.sum("cnt").alias("total_leads"))
    order = Window.partitionBy(*chart).orderBy(F.desc("total_leads"), *series)
    return totals.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= limit)
