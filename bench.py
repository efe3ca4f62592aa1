"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS]. Every query runs to completion through the no-op sink
(full plan executed, nothing collected). Prints ONE JSON line."""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchline.plans import catalog  # noqa: E402
from touchline.plans.reporting import init, update  # noqa: E402
from touchline.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "param_extract",
    "event_traffic",
    "session_rollup",
    "session_traffic_30d",
    "session_traffic_30d_window",
    "events_flat",
    "seconds_since_previous",
    "seconds_since_previous_window",
    "exit_flag",
    "exit_flag_window",
    "events_sessionized",
    "purchase_items",
    "channel_grouping",
    "language_name",
    "sessions_by_channel",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="touchline-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    # Untimed warm-up: the same query shapes on the smallest tables, so JIT and
    # whole-stage-codegen compilation are not billed to the timed runs.
    warm = "/root/testdata/sf0.001"
    for name in HEADLINE:
        _run(catalog.QUERIES[name](spark, warm))
    warm_root = scratch_path(spark, "bench-warm")
    init(spark, catalog.raw_shards(spark, warm), warm_root, dt.date(2024, 2, 2))
    update(spark, catalog.raw_shards(spark, warm), warm_root, dt.date(2024, 1, 17))

    timings: dict[str, float] = {}
    # setup, reported apart: the stand-in export written as day shards
    t0 = time.perf_counter()
    catalog.raw_shards(spark, sf_dir)
    setup = {"raw_shards_write": round(time.perf_counter() - t0, 3)}
    for name in HEADLINE:
        t0 = time.perf_counter()
        _run(catalog.QUERIES[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)

    shards = catalog.raw_shards(spark, sf_dir)
    root = scratch_path(spark, "bench-tables")
    t0 = time.perf_counter()
    init(spark, shards, root, dt.date(2024, 2, 2))
    timings["init_load"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    update(spark, shards, root, dt.date(2024, 1, 17))
    timings["daily_update"] = round(time.perf_counter() - t0, 3)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": timings,
                      "setup": setup, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus,
                      "warm": True}))
    spark.stop()


if __name__ == "__main__":
    main()
