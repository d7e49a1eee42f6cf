"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables and ``BENCH_CPUS`` the number
of local cores. Every query runs in full, into the no-op sink; the best of
``BENCH_RUNS`` runs after one warm-up run counts. The time includes building
the plan and the small jobs that a plan needs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tablewright.catalog.queries import QUERIES
from tablewright.session import build_session

HEADLINE = (
    "silver",
    "silver_ingested_twice",
    "dedup_by_key",
    "dedup_rare",
    "gold_features",
    "fit_vocab",
    "fit_vocab_unbounded",
    "string_index",
    "encode_many",
    "vector_to_array",
    "gold",
    "quality_gate",
    "null_profile",
    "schema_profile",
    "describe_stats",
    "describe_quartiles",
    "duplicate_count",
    "feature_view_apply",
    "materialize_latest",
    "materialize_incremental",
    "online_lookup",
    "point_in_time_join",
    "point_in_time_join_hot",
    "src_tabular",
    "sink_gold",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
        },
        app_name="bench",
        master=f"local[{cpus}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
