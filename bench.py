"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all) and BENCH_RUNS
(default 3, of which the first warms up) choose the input, the cores and the repetitions.
A query's time covers everything it does: planning, the tables or streams it writes, and
computing all columns of all rows of its result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "enrich_int_code",
    "strip_whitespace",
    "left_join_dim",
    "role_playing_dim",
    "enrichment",
    "from_json_nested",
    "flatten_structs",
    "explode_outer",
    "explode_all",
    "explode_vectors",
    "partitioned_replace",
    "stream_append",
    "stream_restart",
    "stream_transactions",
    "batch_enrichment_events",
    "batch_enrichment",
)


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - started
    # The tables a run has written would fill the disk.
    for row in spark.sql("SHOW NAMESPACES LIKE 'run_*'").collect():
        spark.sql(f"DROP NAMESPACE `{row.namespace}` CASCADE")
    return took


def input_partitions(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """How many tasks can read each table at most: a table of one partition keeps one core busy."""
    folders = sorted(Path(sf_dir).glob("*.parquet"))
    return {p.stem: spark.read.parquet(str(p)).rdd.getNumPartitions() for p in folders}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINES
    folder = tempfile.mkdtemp(prefix="run-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        # No checksum files beside those on the local disk: a table of many dates is many files.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        # List the folders of a partitioned table with as many tasks as there are cores.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        times = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    partitions = input_partitions(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries (median of warm runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_partitions": partitions,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else None,
            }
        )
    )


if __name__ == "__main__":
    main()
