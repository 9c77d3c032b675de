"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the local
threads, BENCH_QUERIES (comma separated, or "all") the queries. Each query is
written to the no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "weekly_sales", "quarterly_sales", "enrich_lineitem", "current_lines", "distinct_counts", "classify_parts",
    "latest_order", "latest_day_lines", "effective_join", "cascade_lookup", "exists_or_absent", "asof_prior_event",
    "pair_nth_events", "inside_hold", "change_event", "islands", "floored_counter", "running_counter", "dup_ordinal",
    "unpivot_lineitem", "explode_tokens", "walk_paths", "row_hash", "cdc_upsert", "scd2_apply", "weekly_snapshot",
    "merge_timelines", "fiscal_calendar", "convert_amounts", "billing_fact", "backlog_delinquency", "customer_bridge",
    "pos_fact", "consumption_quarterly", "funnel_snapshot", "product_classes", "entity_state", "risk_burndown",
    "created_vs_resolved", "schedule_steps", "dq_unique", "dq_missing_fk",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tidemark.queries.registry import QUERIES, load_all
    from tidemark.session import session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load_all()
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if picked == "all" else picked.split(",") if picked else HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("lineitem", "orders", "events"):  # start the JVM and the parquet reader
        spark.read.parquet(f"{folder}/{table}.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").split("/")[-1].removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
