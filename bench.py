"""

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query: one warm-up, then the median of three runs. A run builds the
query and forces every column through the ``noop`` sink, so the whole plan
executes without collecting rows to the driver. Writer and stream queries
include their writes. The cluster-by-time pair times one selective time
filter on a table before and after ``cluster_by``; beside it stand the files that can hold
matching rows, and all files of that table partition (``time_filter_files_to_open_of``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidepool.plans import fixtures as fx  # noqa: E402
from tidepool.plans.queries import REGISTRY  # noqa: E402
from tidepool.session import local_session, work_path  # noqa: E402
from tidepool.sources.table import ParquetTable  # noqa: E402

HEADLINE = ["clean_raw", "merge_insert_only", "merge_upsert", "replace_where",
            "delete_where", "soft_delete_read", "stream_csv_ingest", "stale_tables"]
RUNS = 3


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_time(fn) -> float:
    fn()  # warm-up
    return statistics.median(timed(fn) for _ in range(RUNS))


def time_filter(t: ParquetTable):
    """One day of one table partition: the query clustering should speed up."""
    return (t.read().filter((F.col("SensorLocation") == "loc_1")
                            & (F.col("SensorMeasurement") == "view")
                            & (F.col("MeasurementDateTime") >= F.lit("2024-01-10").cast("timestamp_ntz"))
                            & (F.col("MeasurementDateTime") < F.lit("2024-01-11").cast("timestamp_ntz"))))


def files_to_open(t: ParquetTable) -> list[int]:
    """Files of the filtered table partition whose times can match the filter, and all of its files."""
    ts = F.col("MeasurementDateTime")
    each = (t.base().filter((F.col("SensorLocation") == "loc_1") & (F.col("SensorMeasurement") == "view"))
            .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")))
    match = (F.col("lo") < F.lit("2024-01-11").cast("timestamp_ntz")) & (F.col("hi") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return list(each.agg(F.count_if(match), F.count(F.lit(1))).first())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    if not cpus.isdigit():                      # e.g. "*": use every core
        cpus = str(os.cpu_count() or 8)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage and task times for tools/stages.py (no UI is started).
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(cores=cpus, shuffle_partitions=max(2, int(cpus)), extra_conf=extra)
    sc = spark.sparkContext

    # JVM warm-up (class loading, JIT) over the whole set before any timing.
    for name in HEADLINE:
        force(REGISTRY[name](spark, sf_dir))

    results: dict[str, float] = {}
    for name in HEADLINE:
        sc.setJobDescription(f"bench:{name}")
        results[name] = round(median_time(lambda: force(REGISTRY[name](spark, sf_dir))), 3)

    # Time filter before and after clustering by time (setup not timed).
    t = ParquetTable.create_as(spark, work_path(spark, "bench-cluster"),
                               fx.clean(spark, sf_dir, keep_event_id=True),
                               ["SensorLocation", "SensorMeasurement"])
    sc.setJobDescription("bench:time_filter_before_cluster")
    results["time_filter_before_cluster"] = round(median_time(lambda: force(time_filter(t))), 3)
    opened = {"before": files_to_open(t)}
    sc.setJobDescription("bench:cluster_by_time")
    t.cluster_by("MeasurementDateTime")
    opened["after"] = files_to_open(t)
    sc.setJobDescription("bench:time_filter_after_cluster")
    results["time_filter_after_cluster"] = round(median_time(lambda: force(time_filter(t))), 3)

    print(json.dumps({"metric": "total_median_sec", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf,
                      "time_filter_files_to_open_of": opened}))
    spark.stop()


if __name__ == "__main__":
    main()
