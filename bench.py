"""Headline queries, timed; prints one JSON line.

Each query runs once to warm up (class loading, code generation) and is then timed writing to
Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablescout import build_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINES = [
    "scan_incremental",
    "conform_rows",
    "merge_upsert",
    "run_log_latest",
    "shared_columns",
    "profile_columns",
    "key_candidates",
    "value_overlap",
    "value_overlap_edges",
    "cardinality_edges",
    "flat_view",
    "object_view_unknown",
    "bridge_view",
    "summary_view_hot_keys",
    "semantic_catalog",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
