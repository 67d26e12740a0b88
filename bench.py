"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimwright.plans.queries import all_queries  # noqa: E402
from dimwright.session import local_session  # noqa: E402

HEADLINES = [
    "fold_key_text",
    "date_dim",
    "surrogate_keys",
    "wide_to_long_sheet",
    "snowflake_property",
    "scd2_initial_broker",
    "scd2_merge_full",
    "scd2_merge_cdc",
    "scd2_extend_property",
    "scd1_upsert_market",
    "participant_fact_initial",
    "participant_fact_nn",
    "participant_fact_incr",
    "sale_fact_initial",
    "bridge_buyers",
    "aggregate_fact_initial",
    "restate_aggregate_touched",
    "link_benchmark_fact",
    "sale_vs_market_view",
    "measures_by_city",
    "reconcile_sides",
    "constraint_report",
    "feed_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["date_dim"](spark, sf_dir).count()  # warm the session
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
