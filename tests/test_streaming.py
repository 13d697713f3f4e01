"""Streaming hops: exactly-once appends, rerun, replay, multi-batch merge."""

from pyspark.sql import types as T

from tidepool.plans import fixtures as fx
from tidepool.session import work_path
from tidepool.sources.sensor import (CSV_TIME_FORMAT, SILVER_COLUMNS, SILVER_PARTITIONS, sensor_schema,
                                     write_csv_feed)
from tidepool.sources.table import ParquetTable
from tidepool.streaming.pipeline import (bronze_schema, ingest_raw_to_bronze,
                                         merge_bronze_to_silver)
from tests.conftest import SF001

NTZ = T.TimestampNTZType()


def _feed(spark, files=4):
    path = work_path(spark, "feed")
    write_csv_feed(fx.raw(spark, SF001), path, files=files)
    return path


def _ingest(spark, feed, bronze, ckpt, **kw):
    ingest_raw_to_bronze(spark, feed, bronze, ckpt, schema=sensor_schema(NTZ),
                         timestamp_format=CSV_TIME_FORMAT, **kw)


def test_ingest_multi_batch_and_rerun_noop(spark):
    feed = _feed(spark)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    ckpt = work_path(spark, "ckpt")
    _ingest(spark, feed, bronze, ckpt, max_files_per_trigger=1)
    n = fx.clean(spark, SF001).count()
    assert bronze.read().count() == n
    batches = [r for r in bronze.history().collect() if r["operation"] == "STREAMING UPDATE"]
    assert len(batches) == 4
    _ingest(spark, feed, bronze, ckpt, max_files_per_trigger=1)
    assert bronze.read().count() == n
    assert bronze.read().filter("InputFileName LIKE '%.csv'").count() == n


def test_replayed_batch_id_is_noop(spark):
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    rows = fx.clean(spark, SF001).limit(3)
    rows = rows.selectExpr("MeasurementDateTime AS WindowAverageStartDateTime",
                           "MeasurementDateTime AS WindowAverageStopDateTime", "*",
                           "'f' AS InputFileName")
    assert bronze.append(rows, txn=("q", 0)) == 3
    assert bronze.append(rows, txn=("q", 0)) == 0
    assert ParquetTable.open(spark, bronze.root).append(rows, txn=("q", 0)) == 0
    assert bronze.read().count() == 3


def test_new_checkpoint_reingests_and_content_keys_dedupe(spark):
    """T1/T2: a fresh checkpoint re-reads every file (nothing silently
    skipped); the insert-only merge on content keys keeps silver unique."""
    feed = _feed(spark, files=2)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    _ingest(spark, feed, bronze, work_path(spark, "ckpt-1"))
    _ingest(spark, feed, bronze, work_path(spark, "ckpt-2"))
    n = fx.clean(spark, SF001).count()
    assert bronze.read().count() == 2 * n
    b = bronze_schema(NTZ)
    silver_schema = T.StructType([b[c] for c in ["MeasurementDateTime", "SensorValue",
                                                 "SensorUnitDescription", "SensorMeasurement",
                                                 "SensorLocation", "Id", "InputFileName"]])
    silver = ParquetTable.create(spark, work_path(spark, "silver"), silver_schema,
                                 ["SensorLocation", "SensorMeasurement"])
    merge_bronze_to_silver(bronze, silver, work_path(spark, "ckpt-s"), max_files_per_trigger=1)
    assert silver.read().count() == n
    assert silver.read().select("Id").distinct().count() == n


def test_batch_replayed_after_failure_adds_nothing(spark):
    """A failure after a batch's rows are written but before Spark commits
    the batch: the restarted stream replays that batch id, and the append
    recognises it, so no row is written twice."""
    import pytest
    from tidepool.sources.sensor import stream_sensor_csv
    from tidepool.streaming.pipeline import _app_id, bronze_rows

    feed = _feed(spark, files=3)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    ckpt = work_path(spark, "ckpt")
    app = _app_id("flaky", ckpt)
    state = {"failed": False}

    def handler(batch, batch_id):
        bronze.append(batch, operation="STREAMING UPDATE", txn=(app, batch_id))
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("lost after the write, before the commit")

    def run():
        src = stream_sensor_csv(spark, feed, sensor_schema(NTZ), max_files_per_trigger=1,
                                timestamp_format=CSV_TIME_FORMAT)
        q = (bronze_rows(src).writeStream.option("checkpointLocation", ckpt)
             .trigger(availableNow=True).foreachBatch(handler).start())
        q.awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    n = fx.clean(spark, SF001).count()
    assert bronze.read().count() == n
    assert bronze.read().select("Id").distinct().count() == n


def test_batch_that_died_before_it_was_visible_is_written_once(spark, monkeypatch):
    """A crash between the data write and the rename: the replay writes the batch anew."""
    import pytest
    from tidepool.sources import files

    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    rows = fx.clean(spark, SF001).limit(10).selectExpr(
        "MeasurementDateTime AS WindowAverageStartDateTime", "MeasurementDateTime AS WindowAverageStopDateTime",
        "*", "'f' AS InputFileName")

    def lost(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "rename", lost)
        with pytest.raises(OSError):
            bronze.append(rows, txn=("q", 0))
    assert bronze.append(rows, txn=("q", 0)) == 10 and bronze.append(rows, txn=("q", 0)) == 0
    assert bronze.read().count() == 10


def test_silver_is_the_same_for_every_batch_size(spark):
    feed = work_path(spark, "feed")
    rows = fx.raw(spark, SF001)
    write_csv_feed(rows.unionByName(rows), feed, files=2)
    write_csv_feed(rows, feed, files=1)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    _ingest(spark, feed, bronze, work_path(spark, "ckpt"), max_files_per_trigger=1)
    b = bronze_schema(NTZ)
    schema = T.StructType([b[c] for c in SILVER_COLUMNS])
    seen = set()
    for n in (1, 2, None):
        silver = ParquetTable.create(spark, work_path(spark, "silver"), schema, SILVER_PARTITIONS)
        merge_bronze_to_silver(bronze, silver, work_path(spark, "ckpt-s"), max_files_per_trigger=n)
        seen.add(tuple(sorted(r["Id"] for r in silver.read().collect())))
    assert len(seen) == 1 and len(seen.pop()) == fx.clean(spark, SF001).count()


def test_keys_do_not_collide_nor_depend_on_the_zone(spark):
    from tidepool.functions.keys import content_key
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("null", "x")], "a string, b string")
    assert df.select(content_key("a", "b").alias("k")).distinct().count() == 5
    keys = set()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            at = spark.sql("SELECT timestamp_micros(1730613600000001L + id * 3600000000L) AS t FROM range(2)")
            keys |= {r["k"] for r in at.select(content_key("t").alias("k")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(keys) == 2          # two instants an hour apart at a clock change, one key each


def test_run_sensor_pipeline_incremental_and_start_over(spark):
    from pyspark.sql import functions as F
    from tidepool.streaming.pipeline import run_sensor_pipeline

    raw = fx.raw(spark, SF001)
    feed = work_path(spark, "feed")
    write_csv_feed(raw.filter(F.col("MeasurementDateTime") < "2024-01-15"), feed, files=2)
    root = work_path(spark, "pipeline")
    kw = dict(schema=sensor_schema(NTZ), timestamp_format=CSV_TIME_FORMAT)
    first = run_sensor_pipeline(spark, feed, root, cluster=True, **kw).read().count()
    clean = fx.clean(spark, SF001)
    assert first == clean.filter(F.col("MeasurementDateTime") < "2024-01-15").count()
    assert run_sensor_pipeline(spark, feed, root, cluster=False, **kw).read().count() == first
    # new files arrive: only they are processed
    write_csv_feed(raw.filter(F.col("MeasurementDateTime") >= "2024-01-15"), feed, files=2)
    silver = run_sensor_pipeline(spark, feed, root, cluster=True, **kw)
    assert silver.read().count() == clean.count()
    assert silver.partition_by == ["SensorLocation", "SensorMeasurement"]
    # start over: checkpoints and tables reset together, same result
    again = run_sensor_pipeline(spark, feed, root, start_over=True, cluster=True, **kw)
    assert again.read().count() == clean.count()
    # a fresh history: create, one merge batch (all files), optimize
    assert [r["operation"] for r in again.history().collect()] == \
        ["OPTIMIZE", "MERGE", "CREATE TABLE"]


def test_pipeline_on_raw_feed_format(spark):
    """The feed as devices write it (zone-suffixed times, an annotation line
    under the header, a value that does not parse), default schema."""
    from tests.test_cleaning import CSV_SAMPLE
    from tidepool.streaming.pipeline import run_sensor_pipeline
    feed = work_path(spark, "raw-feed")
    lines = spark.createDataFrame([(x,) for x in CSV_SAMPLE.strip().split("\n")], "value string")
    lines.coalesce(1).write.text(feed)
    silver = run_sensor_pipeline(spark, feed, work_path(spark, "pipe"))
    rows = silver.read().collect()
    assert sorted(r["SensorValue"] for r in rows) == [-3, 12, 41, 1013]
    assert {r["SensorLocation"] for r in rows} == {"north_quay", "mill_weir"}
    assert all(r["Id"] and r["InputFileName"].endswith(".txt") for r in rows)


def test_command_line_pipeline(spark):
    """The CLI in its own process (its own session), on a feed Spark wrote."""
    import json
    import os
    import subprocess
    import sys
    feed = work_path(spark, "cli-feed")
    write_csv_feed(fx.raw(spark, SF001), feed, files=2)
    root = work_path(spark, "cli")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": repo}
    run = [sys.executable, "-m", "tidepool", "pipeline", "--source", feed, "--root", root,
           "--timestamp-format", CSV_TIME_FORMAT]
    out = subprocess.run(run, capture_output=True, text=True, timeout=600, env=env, cwd=repo)
    assert out.returncode == 0, out.stderr[-2000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["rows"] == fx.clean(spark, SF001).count()
    hist = subprocess.run([sys.executable, "-m", "tidepool", "history", "--table", res["silver"]],
                          capture_output=True, text=True, timeout=600, env=env, cwd=repo)
    ops = [json.loads(x)["operation"] for x in hist.stdout.strip().splitlines()]
    assert ops == ["MERGE", "CREATE TABLE"]
