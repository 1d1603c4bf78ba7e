"""Time the headline queries and the full build; print one JSON line.

``BENCH_SF_DIR`` names the directory of the star-schema tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from cratewise.plans.build import build
from verification.registry import QUERIES, write_dump

HEADLINE = [
    "norm_text",
    "earliest_dates",
    "scored_candidates",
    "canonical_rank",
    "canonical_map",
    "dim_release_group",
    "dim_artist",
    "dim_recording",
    "text_lookup",
    "link_lookup",
    "tsv_scan",
    "closed_sample_stats",
    "history_resolve",
    "plays_per_release_group",
    "track_details",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cratewise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # No Python call sites in error messages: recording them slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers on something small; not timed.
    QUERIES["canonical_rank"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)

    work = tempfile.mkdtemp(prefix="cratewise-bench-")
    write_dump(spark, sf_dir, f"{work}/dump")
    started = time.perf_counter()
    build(spark, f"{work}/dump", f"{work}/out")
    seconds["full_build"] = round(time.perf_counter() - started, 3)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
