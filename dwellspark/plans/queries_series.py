"""Queries for distributions, pivots, matrices and dimension lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwellspark.operators import histogram as H
from dwellspark.operators import matrix as X
from dwellspark.operators import pivots as P
from dwellspark.operators.filters import filter_series
from dwellspark.operators.norms import norms
from dwellspark.operators.snapshot import lead_snapshot

from dwellspark.plans.fixtures import event_reports, stage_reports
from dwellspark.plans.queries_norms import all_records, both_scopes, stats_sql
from dwellspark.plans.registry import cte, query
from dwellspark.plans.settings import METRICS

SERIES = ("tb", "product_group", "product", "stage_key", "metric")
_S = ", ".join(SERIES)

cte(
    "se",
    """SELECT tb, product_group, product, stage_key, metric, d FROM
         (SELECT unnest([tb, '__ALL__']) AS tb, product_group, product, stage_key, unnest(['x']) AS dummy,
            days_on_stage, days_since_deal FROM sr_rec)
         CROSS JOIN LATERAL (SELECT 'days_on_stage' AS metric, cast(round_even(days_on_stage, 0) AS bigint) AS d
            UNION ALL SELECT 'days_since_deal', cast(round_even(days_since_deal, 0) AS bigint))""".replace(
        "unnest(['x']) AS dummy,\n            ", ""
    ),
)
cte("seh", f"SELECT {_S}, d AS day, count(*) AS cnt FROM se GROUP BY {_S}, d")


def series(spark, sf):
    return H.series_histogram(all_records(spark, sf))


@query(
    "q_distribution",
    f"""SELECT {_S}, day, cnt, cast(sum(cnt) OVER (w ORDER BY day) AS bigint) - cnt + 1 AS first_lead,
        cast(sum(cnt) OVER (w ORDER BY day) AS bigint) AS last_lead, cast(sum(cnt) OVER w AS bigint) AS total_leads
        FROM seh WINDOW w AS (PARTITION BY {_S})""",
)
def q_distribution(spark, sf):
    return H.distribution(series(spark, sf), SERIES)


@query(
    "q_series_filter",
    f"SELECT {_S}, sum(cnt)::bigint AS leads FROM seh WHERE tb IN ('ASIA', 'EUROPE') AND metric = 'days_on_stage' "
    f"AND product_group IN ('PROMO', 'SMALL') AND stage_key = 'AF' GROUP BY {_S}",
)
def q_series_filter(spark, sf):
    chosen = filter_series(
        series(spark, sf), ["ASIA", "EUROPE", "__ALL__"], ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
        "days_on_stage", ["PROMO", "SMALL"], stage="AF",
    )
    return chosen.groupBy(*SERIES).agg(F.sum("cnt").alias("leads"))


@query("q_merge_series", "SELECT tb, stage_key, metric, day, sum(cnt)::bigint AS cnt FROM seh GROUP BY ALL")
def q_merge_series(spark, sf):
    return H.merge_series(series(spark, sf), ["tb", "stage_key", "metric"])


CURVE = ("product_group", "product", "stage_key")
_C = ", ".join(CURVE)
cte("rk", f"""SELECT {_C}, cast(round_even(days_on_stage, 0) AS bigint) AS days,
       row_number() OVER (PARTITION BY {_C} ORDER BY round_even(days_on_stage, 0)) AS lead_index,
       count(*) OVER (PARTITION BY {_C}) AS n FROM sr_rec""")


def curve_histogram(spark, sf):
    return H.day_histogram(all_records(spark, sf), CURVE)


@query("q_rank_curve", f"SELECT {_C}, lead_index, days FROM rk")
def q_rank_curve(spark, sf):
    return H.rank_curve(curve_histogram(spark, sf), CURVE)


@query(
    "q_downsample",
    f"""WITH st AS (SELECT *, cast(greatest(1, ceil(n / 10)) AS bigint) AS step FROM rk),
        lx AS (SELECT {_C}, max(days) FILTER (WHERE (lead_index - 1) % step = 0) AS last_days FROM st GROUP BY {_C})
        SELECT {', '.join('st.' + c for c in CURVE)}, lead_index, days FROM st JOIN lx USING ({_C})
        WHERE (lead_index - 1) % step = 0 OR (lead_index = n AND days <> last_days)""",
)
def q_downsample(spark, sf):
    return H.downsample(curve_histogram(spark, sf), CURVE, 10)


@query(
    "q_ecdf",
    f"""SELECT {_S}, day, floor(cast(sum(cnt) OVER (w ORDER BY day) AS double) / sum(cnt) OVER w * 1000 + 0.5) / 10 AS share_pct
        FROM seh WINDOW w AS (PARTITION BY {_S})""",
)
def q_ecdf(spark, sf):
    return H.ecdf(series(spark, sf), SERIES)


@query(
    "q_series_summary",
    stats_sql("se", SERIES, "days", "d").replace(" AS days_", " AS days_"),
)
def q_series_summary(spark, sf):
    return H.percentile_stats(series(spark, sf), SERIES, prefix="days")


def _histogram_sql(bars):
    return f"""WITH fr AS (SELECT {_S}, min(day) AS lo, max(day) AS hi, count(*) AS u FROM seh GROUP BY {_S}),
        sz AS (SELECT *, CASE WHEN u <= {bars} THEN 1 ELSE cast(greatest(1, ceil((hi - lo + 1) / {bars})) AS bigint) END AS size FROM fr),
        b AS (SELECT {', '.join('sz.' + c for c in SERIES)}, size, lo + cast(floor((day - lo) / size) AS bigint) * size AS s, cnt
              FROM seh JOIN sz USING ({_S}))
        SELECT {_S}, s AS bucket_start, s + size - 1 AS bucket_end, size AS bucket_size,
          s + cast(size AS double) / 2 - 0.5 AS x, sum(cnt)::bigint AS leads FROM b GROUP BY {_S}, s, size"""


@query("q_histogram", _histogram_sql(36))
def q_histogram(spark, sf):
    return H.histogram(series(spark, sf), SERIES)


CHART, LINE = ("tb", "stage_key", "metric"), ("product_group", "product")


def _aligned_sql(bars):
    """Buckets of each chart by day or by width; every series of the chart over all of them."""
    c, s = ", ".join(CHART), ", ".join(LINE)
    return f"""WITH fr AS (SELECT {c}, min(day) AS lo, max(day) AS hi, count(DISTINCT day) AS u FROM seh GROUP BY {c}),
        sz AS (SELECT *, cast(greatest(1, ceil((hi - lo + 1) / {bars})) AS bigint) AS size FROM fr),
        bu AS (SELECT {c}, start_day, least(start_day + size - 1, hi) AS end_day FROM
                 (SELECT *, unnest(range(lo, hi + 1, size)) AS start_day FROM sz WHERE u > {bars})
               UNION ALL SELECT DISTINCT {', '.join('sz.' + k for k in CHART)}, day, day FROM sz JOIN seh USING ({c}) WHERE u <= {bars}),
        nb AS (SELECT *, row_number() OVER (PARTITION BY {c} ORDER BY start_day) - 1 AS bucket FROM bu),
        nm AS (SELECT DISTINCT {c}, {s} FROM seh)
        """


_ALIGNED_COUNT = f"""SELECT {', '.join('nm.' + k for k in (*CHART, *LINE))}, cast(bucket AS integer) AS bucket, start_day, end_day,
    coalesce(sum(cnt), 0)::bigint AS leads FROM nm JOIN nb USING ({', '.join(CHART)})
    LEFT JOIN seh h ON {' AND '.join(f'h.{k} = nm.{k}' for k in (*CHART, *LINE))} AND h.day BETWEEN start_day AND end_day
    GROUP BY {', '.join('nm.' + k for k in (*CHART, *LINE))}, bucket, start_day, end_day"""


@query("q_aligned_histogram", _aligned_sql(24) + _ALIGNED_COUNT)
def q_aligned_histogram(spark, sf):
    return H.aligned_histogram(series(spark, sf), CHART, LINE)


cte("sp", stats_sql("se", SERIES, "days", "d", percentiles=(80,)))


@query(
    "q_bucket_of_percentile",
    _aligned_sql(24)
    + f"""SELECT {', '.join('sp.' + k for k in (*CHART, *LINE))}, days_p80_days AS percentile_day, cast(bucket AS integer) AS bucket
        FROM sp JOIN nb ON {' AND '.join(f'sp.{k} = nb.{k}' for k in CHART)} AND days_p80_days BETWEEN start_day AND end_day""",
)
def q_bucket_of_percentile(spark, sf):
    return H.bucket_of_percentile(series(spark, sf), CHART, LINE)


@query(
    "q_top_series",
    f"""SELECT {', '.join(CHART)}, {', '.join(LINE)}, total_leads, cast(position AS integer) AS position FROM
        (SELECT *, row_number() OVER (PARTITION BY {', '.join(CHART)} ORDER BY total_leads DESC, {', '.join(LINE)}) AS position FROM
          (SELECT {', '.join(CHART)}, {', '.join(LINE)}, sum(cnt)::bigint AS total_leads FROM seh GROUP BY ALL)) WHERE position <= 5""",
)
def q_top_series(spark, sf):
    return H.top_series(series(spark, sf), CHART, LINE, 5)


# --- pivots -----------------------------------------------------------------------------

PIVOT_GROUP = ("is_all", "tb", "product_group", "product", "stage_key", "analysis_level")
cte("pa", both_scopes("sr_rec"))
cte("pn1", stats_sql("pa", PIVOT_GROUP))
cte("pn2", stats_sql("pa", PIVOT_GROUP, "days_since_deal", "d2"))


def _flat_sql():
    parts = []
    for src, m in (("pn1", "days_on_stage"), ("pn2", "days_since_deal")):
        for i in ("min", "max", "p20", "p50", "p80"):
            value = f"{m}_{i}" if i in ("min", "max") else f"{m}_{i}_days"
            parts.append(
                f"""SELECT CASE WHEN is_all THEN '__ALL__' ELSE tb END AS tb, product_group, product, product AS row_key, stage_key,
                analysis_level, '{m}' AS metric, '{i}' AS indicator, {value} AS value, {m}_{i}_le_count AS leads_le,
                {m}_{i}_gt_count AS leads_gt FROM {src}"""
            )
    return " UNION ALL ".join(parts)


cte("pf", _flat_sql())


def flat(spark, sf):
    keys = ("product_group", "product", "stage_key", "analysis_level")
    return P.pivot_flat(norms(all_records(spark, sf, km=False), keys, METRICS, km=None), METRICS)


@query("q_pivot_flat", "SELECT * FROM pf")
def q_pivot_flat(spark, sf):
    return flat(spark, sf)


STAGES = ("AF", "AO", "NF", "NO", "RF", "RO")


def _matrix_sql(keys, where="true"):
    cells = ", ".join(f"max(value) FILTER (WHERE stage_key = '{s}') AS \"{s}\"" for s in STAGES)
    return f"SELECT {', '.join(keys)}, {cells} FROM pf WHERE {where} GROUP BY {', '.join(keys)}"


_GP = ("product_group", "row_key")


@query(
    "q_pivot_matrix",
    _matrix_sql(_GP, "tb = '__ALL__' AND metric = 'days_on_stage' AND indicator = 'p80'"),
)
def q_pivot_matrix(spark, sf):
    return P.pivot_matrix(flat(spark, sf), STAGES, _GP, ["__ALL__"], "days_on_stage", "p80")


@query("q_pivot_all", _matrix_sql(("tb", "product_group", "row_key", "metric", "indicator")))
def q_pivot_all(spark, sf):
    return P.pivot_matrix(flat(spark, sf), STAGES, ("tb", "product_group", "row_key", "metric", "indicator"))


@query(
    "q_pivot_multi_tb",
    """SELECT row_key, metric, indicator, stage_key, value, leads_le, leads_gt FROM
       (SELECT *, row_number() OVER (PARTITION BY row_key, metric, indicator, stage_key ORDER BY value DESC, leads_le DESC, tb DESC, leads_gt DESC) AS rn
        FROM pf WHERE tb IN ('ASIA', 'EUROPE')) WHERE rn = 1""",
)
def q_pivot_multi_tb(spark, sf):
    chosen = flat(spark, sf).filter(F.col("tb").isin("ASIA", "EUROPE"))
    return P.pivot_cells(chosen)


@query(
    "q_pivot_sorted",
    _matrix_sql(("row_key",), "tb = '__ALL__' AND metric = 'days_on_stage' AND indicator = 'p50'") + " ORDER BY \"AO\", row_key",
)
def q_pivot_sorted(spark, sf):
    matrix = P.pivot_matrix(flat(spark, sf), STAGES, ("row_key",), ["__ALL__"], "days_on_stage", "p50")
    return P.sort_rows(matrix, "AO")


@query(
    "q_stage_order",
    """SELECT stage_key, cast(position AS integer) AS position FROM (
         SELECT unnest(['NF', 'XX', 'AO']) AS stage_key, unnest([1, 2, 3]) AS position
         UNION ALL SELECT stage_key, 3 + row_number() OVER (ORDER BY stage_key) FROM
           (SELECT DISTINCT stage_key FROM sr_rec WHERE stage_key NOT IN ('NF', 'AO', 'RO')))""",
)
def q_stage_order(spark, sf):
    return P.stage_order(all_records(spark, sf), ["NF", "XX", "ro", "AO"], excluded=["RO"])


# --- duration matrices ----------------------------------------------------------------------


def line_snapshot(spark, sf):
    columns = ("seq", "lead_id", "report_date", "days_on_stage", "product_group", "product", "current_status")
    return lead_snapshot(stage_reports(spark, sf, *columns))


cte(
    "dm",
    """SELECT product_group, product, cast(round_even(days_on_stage, 0) AS bigint) AS day, count(*) AS cnt
       FROM sr_snap GROUP BY ALL""",
)
cte(
    "dms",
    """SELECT product_group, product, current_status, cast(round_even(days_on_stage, 0) AS bigint) AS day, count(*) AS cnt
       FROM sr_snap GROUP BY ALL""",
)


@query("q_duration_matrix", "SELECT * FROM dms")
def q_duration_matrix(spark, sf):
    return X.matrix_counts(line_snapshot(spark, sf), include_status=True)


@query("q_duration_totals", "SELECT day, sum(cnt)::bigint AS leads FROM dm GROUP BY GROUPING SETS ((day), ())")
def q_duration_totals(spark, sf):
    return X.matrix_totals(X.matrix_counts(line_snapshot(spark, sf)))


cte("dmr", "SELECT product_group, product, cast(round_even(days_on_stage, 0) AS bigint) AS d FROM sr_snap")
cte("dmp", stats_sql("dmr", ("product_group", "product"), "d", "d"))


@query(
    "q_duration_percentiles",
    "SELECT product_group, product, d_count AS total, d_p20_days AS p20, d_p50_days AS p50, d_p80_days AS p80 FROM dmp",
)
def q_duration_percentiles(spark, sf):
    return X.matrix_percentiles(X.matrix_counts(line_snapshot(spark, sf)))


@query(
    "q_duration_trim",
    """SELECT * FROM dm WHERE day IN (SELECT day FROM dm GROUP BY day ORDER BY sum(cnt) DESC, day LIMIT 20)""",
)
def q_duration_trim(spark, sf):
    return X.matrix_counts(line_snapshot(spark, sf), max_days=20)


def _layout_sql(src, keys, row_order, day_order, volume=""):
    k = ", ".join(keys)
    return f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY {row_order}) AS rp FROM
          (SELECT {k}, row_total {volume} FROM (SELECT {k}, sum(cnt)::bigint AS row_total FROM {src} GROUP BY {k}))),
        y AS (SELECT *, row_number() OVER (ORDER BY {day_order}) AS dp FROM (SELECT day, sum(cnt)::bigint AS day_total FROM {src} GROUP BY day))
        SELECT {', '.join('m.' + c for c in keys)}, m.day, cnt, row_total, day_total, cast(rp AS integer) AS row_position,
          cast(dp AS integer) AS day_position FROM {src} m JOIN r USING ({k}) JOIN y ON m.day = y.day"""


def _layout(spark, sf, layout, include_status=False):
    counts = X.matrix_counts(line_snapshot(spark, sf), include_status)
    return X.duration_matrix(counts, include_status, layout)


@query(
    "q_matrix_by_volume",
    _layout_sql("dms", ("product_group", "product", "current_status"),
                "row_total DESC, lower(product_group), lower(product), lower(current_status)", "day_total DESC, day"),
)
def q_matrix_by_volume(spark, sf):
    return _layout(spark, sf, "by_volume", True)


@query(
    "q_matrix_alpha",
    _layout_sql("dm", ("product_group", "product"), "lower(product_group), lower(product)", "day"),
)
def q_matrix_alpha(spark, sf):
    return _layout(spark, sf, "alpha_days")


@query(
    "q_matrix_group_alpha",
    _layout_sql(
        "dms", ("product_group", "product", "current_status"),
        "lower(product_group), vol DESC, lower(product), lower(current_status)", "day",
        ", sum(row_total) OVER (PARTITION BY product_group, product) AS vol",
    ),
)
def q_matrix_group_alpha(spark, sf):
    return _layout(spark, sf, "group_alpha_product_volume", True)


@query(
    "q_matrix_wide",
    "SELECT product_group, product, sum(cnt)::bigint AS total, count(*) AS days, max(cnt) FILTER (WHERE day = 7) AS at_seven FROM dm GROUP BY ALL",
)
def q_matrix_wide(spark, sf):
    wide = X.wide_rows(X.matrix_counts(line_snapshot(spark, sf)))
    return wide.select(
        "product_group", "product", "total", F.size("leads_by_day").cast("long").alias("days"),
        F.try_element_at("leads_by_day", F.lit(7).cast("long")).alias("at_seven"),
    )


# --- dimension lists -----------------------------------------------------------------------------


@query(
    "q_dimensions",
    "SELECT 'tb' AS dimension, tb AS value FROM sr UNION SELECT 'product_group', product_group FROM sr "
    "UNION SELECT 'deal_stage', deal_stage FROM sr UNION SELECT 'efs_flag', cast(efs_flag AS varchar) FROM sr",
)
def q_dimensions(spark, sf):
    return P.dimensions(stage_reports(spark, sf, "tb", "product_group", "deal_stage", "efs_flag"), ["deal_stage", "efs_flag"])


@query("q_product_pairs", "SELECT DISTINCT product_group, product FROM sr")
def q_product_pairs(spark, sf):
    return P.product_pairs(stage_reports(spark, sf, "product_group", "product"))


@query(
    "q_stage_map",
    """SELECT current_status, string_agg(DISTINCT deal_stage, ', ' ORDER BY deal_stage) FILTER (WHERE deal_stage NOT IN ('-', 'nan')) AS deal_stages
       FROM er GROUP BY current_status""",
)
def q_stage_map(spark, sf):
    stages = P.stage_map(event_reports(spark, sf, "current_status", "deal_stage"))
    return stages.select("current_status", F.array_join("deal_stages", ", ").alias("deal_stages"))


@query(
    "q_group_products",
    "SELECT product_group, string_agg(DISTINCT product, ', ' ORDER BY product) AS products FROM sr GROUP BY product_group",
)
def q_group_products(spark, sf):
    found = P.group_products(stage_reports(spark, sf, "product_group", "product"))
    return found.select("product_group", F.array_join("products", ", ").alias("products"))
