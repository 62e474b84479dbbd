"""Times the named queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

A query is run to the end into the ``noop`` sink: every column of every row is produced, nothing is fetched. The
number given is the median of the warm runs; queries that write tables of their own run once, since each run starts
from nothing.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdcmart.samples.queries import QUERIES, prepared  # noqa: E402
from cdcmart.session import build_session  # noqa: E402

WRITING = (
    "nested_csv_load",
    "csv_load_items",
    "csv_load_stores",
    "csv_load_rates",
    "raw_parquet_load",
    "partitioned_sink",
    "stream_items",
    "refresh_full",
    "refresh_incremental",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = sys.argv[1:] or list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="cdcmart-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only:
        query = prepared(QUERIES[name])
        runs = [timed(query, spark, sf_dir)]
        if name not in WRITING:
            runs = [timed(query, spark, sf_dir) for _ in range(warm_runs)]
        seconds[name] = round(statistics.median(runs), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total warm seconds over all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else sf_dir,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
