"""Benchmark: wall seconds of the headline queries, one JSON line.

Every query is run to the end with all its rows and columns (no-op sink), once,
after a small query that warms up the JVM. BENCH_ROUNDS=2 runs all of them twice
and reports the second round, with the first beside it. One whole report run is
timed as well, with its input rows per second.
"""

from __future__ import annotations

import json
import os
import time

from dwellspark.plans.catalog import QUERIES
from dwellspark.plans.fixtures import stage_reports, team_members
from dwellspark.plans.queries_runs import SPEC
from dwellspark.plans.report import report
from dwellspark.session import local_session, release

HEADLINE = (
    "q_normalize_reports",
    "q_ordered_filters",
    "q_funnel",
    "q_group_funnel",
    "q_stage_records_lines",
    "q_lead_snapshot_lines",
    "q_norms",
    "q_norms_two_metrics",
    "q_slice_norms",
    "q_exceedance",
    "q_latest_leaders",
    "q_lead_leaders",
    "q_team_compose",
    "q_manager_totals",
    "q_top_managers",
    "q_stuck_items",
    "q_manager_summary",
    "q_violations",
    "q_distribution",
    "q_histogram",
    "q_aligned_histogram",
    "q_pivot_all",
    "q_matrix_by_volume",
    "q_status_pivot",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


#: Parts of the whole run; what several of them need is made once.
PARTS = ("snapshot", "norms", "funnel", "manager_summary", "duration_matrix")


def report_run(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of one report run and rows of its input per second."""
    start = time.perf_counter()
    tables = report(stage_reports(spark, sf_dir), SPEC, PARTS, team=team_members(spark, sf_dir))
    for df in tables.values():
        df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    release(spark)
    return {"seconds": round(seconds, 3), "rows": rows, "rows_per_second": round(rows / seconds)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "q_funnel_extreme", sf_dir)
    rounds = [
        {n: run(spark, n, sf_dir) for n in names} for _ in range(int(os.environ.get("BENCH_ROUNDS", "1")))
    ]
    seconds = rounds[-1]
    whole = report_run(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "report_run": whole,
                **({"first_round": rounds[0]} if len(rounds) > 1 else {}),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
