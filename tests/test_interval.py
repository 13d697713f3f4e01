"""Long-running streams on an interval trigger, and their stop rule."""

import pytest
from pyspark.sql import types as T

from tests.conftest import SF001
from tidepool.plans import fixtures as fx
from tidepool.session import work_path
from tidepool.sources.sensor import CSV_TIME_FORMAT, sensor_schema, write_csv_feed
from tidepool.sources.table import ParquetTable
from tidepool.streaming.interval import IDLE_REPORTS, Watch
from tidepool.streaming.pipeline import bronze_schema, ingest_raw_to_bronze, run_stream

NTZ = T.TimestampNTZType()


def start(spark, feed, bronze, checkpoint, seen):
    return ingest_raw_to_bronze(spark, feed, bronze, checkpoint, sensor_schema(NTZ), max_files_per_trigger=1,
                                query_name=seen.query_name, trigger=seen.trigger, await_done=False,
                                timestamp_format=CSV_TIME_FORMAT)


def test_several_triggers_then_idle(spark):
    feed, n = work_path(spark, "feed"), fx.clean(spark, SF001).count()
    write_csv_feed(fx.raw(spark, SF001), feed, files=3)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    checkpoint, before = work_path(spark, "ckpt"), spark.conf.get(IDLE_REPORTS, None)
    with Watch(spark, "interval_a", "50 milliseconds") as seen:
        seen.stop_when_idle(start(spark, feed, bronze, checkpoint, seen), triggers=2)
    assert (seen.batches, seen.stopped_by, seen.batch_id) == (3, "idle", 2) and seen.idle >= 2
    assert seen.rows == n               # the cleaning filter is in the scan: rows without a value do not count
    assert bronze.read().count() == n
    assert spark.conf.get(IDLE_REPORTS, None) == before
    write_csv_feed(fx.raw(spark, SF001).filter("SensorValue IS NOT NULL").limit(7), feed, files=1)     # the next run takes the new file only
    with Watch(spark, "interval_a", "50 milliseconds") as seen:
        seen.stop_when_idle(start(spark, feed, bronze, checkpoint, seen))
    assert (seen.batches, seen.rows) == (1, 7)


def test_time_limit_then_the_rest(spark):
    feed = work_path(spark, "feed")
    write_csv_feed(fx.raw(spark, SF001), feed, files=4)
    bronze = ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ))
    checkpoint = work_path(spark, "ckpt")
    with Watch(spark, "interval_b", "1 hour") as seen:              # the second trigger never comes
        q = start(spark, feed, bronze, checkpoint, seen)
        seen.stop_when_idle(q, seconds=0.0)
    assert seen.stopped_by == "time"
    with Watch(spark, "interval_b", "50 milliseconds") as seen:
        seen.stop_when_idle(start(spark, feed, bronze, checkpoint, seen))
    assert seen.stopped_by == "idle" and bronze.read().count() == fx.clean(spark, SF001).count()


def test_failure_is_raised_and_the_listener_goes(spark):
    feed = work_path(spark, "feed")
    write_csv_feed(fx.raw(spark, SF001), feed, files=1)
    rows = spark.readStream.schema(sensor_schema(NTZ)).csv(feed)

    def broken(batch, batch_id):
        raise OSError("sink is gone")

    with pytest.raises(RuntimeError, match="sink is gone"):
        with Watch(spark, "interval_c", "50 milliseconds") as seen:
            q = run_stream(rows, "interval_c", work_path(spark, "ckpt"), broken, seen.trigger, False)
            seen.stop_when_idle(q, seconds=60)
    assert seen.batches == 0


def test_other_streams_are_not_counted(spark):
    feed = work_path(spark, "feed")
    write_csv_feed(fx.raw(spark, SF001), feed, files=1)
    bronze = [ParquetTable.create(spark, work_path(spark, "bronze"), bronze_schema(NTZ)) for _ in range(2)]
    with Watch(spark, "interval_d", "50 milliseconds") as seen, Watch(spark, "interval_e", "50 milliseconds") as other:
        qs = [start(spark, feed, t, work_path(spark, "ckpt"), s) for t, s in zip(bronze, (seen, other))]
        for q, s in zip(qs, (seen, other)):
            s.stop_when_idle(q)
    assert seen.batches == other.batches == 1
