"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_QUERIES``
(comma-separated, or ``all``). Every query writes its whole result to a ``noop`` sink;
the best of ``BENCH_RUNS`` passes over the list counts.
"""

from __future__ import annotations

import json
import os
import time

from larder.queries import QUERIES
from larder.session import build_session

HEADLINE = [
    "order_metrics", "filter_group_mean", "grouped_kpi", "select_filter_sort", "regex_clean", "scores", "weekday_names",
    "inner_join_keys", "left_join_count", "three_way_join", "join_hints", "salted_join", "salted_join_all",
    "anti_join_orphans", "preagg_join", "rollup_single", "cube_report", "grouping_sets_report", "pivot_avg",
    "amount_quartiles", "quartiles", "collect_members", "monthly_summary", "monthly_running_mom", "ranks",
    "lag_lead_diff", "running_range", "ntile_percent_rank", "daily_running_revenue", "top_n_per_group",
    "top_rows_per_group", "dedup_latest", "rolling_mean", "group_avg_diff", "global_revenue_rank", "top_k",
    "quality_gate", "profile", "udf_scalar", "udf_pandas", "roundtrip_parquet", "roundtrip_csv",
    "roundtrip_partitioned", "bucketed_join", "ps_groupby_agg", "ps_merge_rank_shift", "e2e_metrics",
    "medallion_paths", "sql_revenue_report", "sql_monthly_trend", "ps_filter_assign", "rating_bucket",
    "repartition_cache",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # Whole passes, so that every query is timed on a warm JVM too.
    passes = [{name: run(name) for name in names} for _ in range(runs)]
    seconds = {name: round(min(times[name] for times in passes), 4) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
