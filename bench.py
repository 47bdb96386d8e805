"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query, the best one counts (default 2)
"""

from __future__ import annotations

import json
import os
import time

from sparklake.queries import QUERIES
from sparklake.session import build_session

HEADLINE = [
    "kpi_by_province_month",
    "gold_with_macro",
    "lookback_gold",
    "gold_upsert",
    "alert_trend",
    "risk_percentile",
    "silver_clean_flags",
    "silver_clean_lenient",
    "dedup_latest",
    "dedup_latest_coarse_key",
    "landing_to_silver_rows",
    "dq_verdict",
    "mora_by_entity",
    "concentration_hhi",
    "evolution_yoy",
    "coverage_gaps",
    "json_rows",
    "json_series_detect",
    "watermark_filter",
    "bronze_write_read",
    "silver_from_landing",
    "gold_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name], cold[name] = round(min(taken), 3), round(taken[0], 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
