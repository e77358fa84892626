"""Benchmark the headline queries.

Runs every headline query of the registry on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver; the sink queries also write and read back).
One untimed warm-up pass runs first (JVM warm-up, sentiment model fit); the
reported time per query is the median of ``$BENCH_REPEAT`` (default 3) timed
runs. ``load_rows_per_sec`` writes the four entity tables as sized Parquet.

Note: every test table is a single Parquet row group, so each scan is one
task at any split size; CPU-heavy text queries run on one core here.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_daily_summary",
    "gold_post_performance",
    "gold_user_snapshot",
    "gold_content_trends",
    "silver_users",
    "silver_posts",
    "silver_comments",
    "dq_missing",
    "dq_duplicates",
    "clean_text",
    "sentiment_posts",
    "chunk_summary",
    "bronze_likes",
    "verify_gold",
    "sink_parquet_sized",
    "sink_chunked",
    "stream_chunk_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from strata.plans.registry import all_queries
    from strata.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="strata-bench", conf={
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    registry = all_queries()
    names = [n for n in HEADLINE if n in registry]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        registry[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up
        run(name)
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    # Load throughput (BASELINE's only measured number is a bulk load): the
    # four entity tables written as sized Parquet, rows per second.
    from strata.fixtures import Fixture
    from strata.session import scratch_path
    from strata.sources.sinks import write_sized
    fx = Fixture(spark, sf_dir)
    tables = {"users": fx.users(), "posts": fx.posts(), "comments": fx.comments(),
              "likes": fx.likes()}
    n_rows = sum(df.count() for df in tables.values())
    t0 = time.perf_counter()
    for name, df in tables.items():
        write_sized(df, scratch_path(spark, f"bench_load_{name}"))
    load_sec = time.perf_counter() - t0
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "load_rows": n_rows,
        "load_rows_per_sec": round(n_rows / load_sec, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
