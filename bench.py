"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed end to end into Spark's ``noop`` sink (the whole plan
runs, nothing is collected to the driver): one warm-up, then the median of
three timed runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citymarts.plans.driver_queries import QUERIES  # noqa: E402
from citymarts.session import build_session  # noqa: E402
from citymarts.sources.tables import DRIVER_TABLES  # noqa: E402

HEADLINE = [
    "composite_score",
    "environment_mart",
    "rate_fanout",
    "stress_bucket",
    "standings",
    "pillar_contributions",
    "three_way_join",
    "latest_by_key",
    "latest_snapshot",
    "last_non_null",
    "dedupe_first",
    "same_day_duplicate_flag",
    "delivery_outcomes",
    "anti_join_load",
    "zip_arrays_unnest",
    "record_array_unnest",
    "poi_counts",
    "radius_catchment",
    "economic_indicator",
    "prev_obs_pct_change",
    "daily_rollup",
    "freshness_verdict",
    "quarantine_split",
    "gates_report",
    "fx_fact_builder",
    "indicator_records",
    "infrastructure_snapshots",
]


def _input_rows(sf_dir: str) -> dict[str, int]:
    """Row count of every input table, from the parquet footers (no Spark job)."""
    import pyarrow.parquet as pq

    out = {}
    for name in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            out[name] = pq.ParquetFile(path).metadata.num_rows
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        f"local[{cpus}]",
        app_name="citymarts-bench",
        shuffle_partitions=cpus * 2,
        extra_conf={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.checkpoint.dir": os.environ.get("BENCH_CKPT", tempfile.mkdtemp(prefix="citymarts-bench-")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    rows_out: dict[str, int] = {}
    count_rows = os.environ.get("BENCH_ROWS", "1") == "1"
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
        if count_rows:
            rows_out[name] = fn(spark, sf_dir).count()  # untimed
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "runs": runs,
                      "rows_out": rows_out, "input_rows": _input_rows(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
