"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tributary.plans import catalog  # noqa: E402
from tributary.session import build_session  # noqa: E402

HEADLINE = [
    "s4_event_time",
    "route_summary",
    "c9_log_events",
    "a2_notifications",
    "e1_route",
    "e8_reconcile",
    "d7_skip_processed",
    "g1_order_events",
    "g2_pack_deliveries",
    "g2_pack_routed_lines",
    "g2_pack_hot_stream",
    "a9_partial_lines",
    "g4_heartbeat_gaps",
    "f1_batch_summary",
    "f8_event_metrics",
    "f11_statistics_300",
    "h4_expand_groups",
    "m1_create_table",
    "m2_update_table",
    "m5_validation_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.log.level": "ERROR",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    jobs = catalog.jobs()

    def run(name: str) -> float:
        start = time.perf_counter()
        jobs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    only = sys.argv[1:] or HEADLINE
    times = {}
    for name in only:
        run(name)  # first run: compiles the plan's code and starts Python workers
        times[name] = round(run(name), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    line = {
        "metric": "headline queries, wall time of the second run of each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events,
        "events_per_sec": {n: round(events / times[n]) for n in ("s4_event_time", "route_summary", "g2_pack_routed_lines") if n in times},
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
