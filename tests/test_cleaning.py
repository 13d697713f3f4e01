"""The cleaning transform and the raw feed's CSV semantics."""

import pytest
from pyspark.sql import types as T

from tidepool.functions.casting import parse_typed
from tidepool.functions.cleaning import clean_raw_data, drop_columns, project_to_target
from tidepool.sources.sensor import (RAW_COLUMNS, read_sensor_csv, sensor_schema,
                                     stream_sensor_csv)

BRONZE = ["WindowAverageStartDateTime", "WindowAverageStopDateTime", "MeasurementDateTime",
          "SensorValue", "SensorUnitDescription", "SensorMeasurement", "SensorLocation",
          "Id", "InputFileName"]


def test_clean_raw_data(spark):
    """Four all-string rows: rows without a value go, junk columns go, cells that do not parse
    become NULL and keep their row."""
    junk = ["x", "y", "z"]
    rows = [(*junk, "2021-05-02 06:00:00", "2021-05-02 07:00:00", "2021-05-02 06:30:00", "12.4",
             "hectopascal", "air_pressure_change", "north_quay", "r1", "a.csv"),
            (*junk, "2021-05-02 07:00:00", "noon", "2021-05-02 07:30:00", "-3",
             "centimetre", "water_level", "mill_weir", "r2", "a.csv"),
            (*junk, None, None, None, None, None, "water_level", "mill_weir", "r3", "b.csv"),
            (*junk, "2021-05-02 08:00:00", None, "2021-05-02 08:30:00", "41,5",
             "centimetre", "water_level", "mill_weir", "r4", "b.csv")]
    schema = T.StructType([T.StructField(c, T.StringType(), True)
                           for c in RAW_COLUMNS + ["InputFileName"]])
    out = spark.createDataFrame(rows, schema).transform(clean_raw_data)
    assert out.columns == BRONZE
    got = {r["Id"]: r for r in parse_typed(out, sensor_schema(T.TimestampNTZType())).collect()}
    assert sorted(got) == ["r1", "r2", "r4"]
    assert [got[i]["SensorValue"] for i in ("r1", "r2", "r4")] == [12, -3, None]
    assert got["r2"]["WindowAverageStopDateTime"] is None and got["r2"]["SensorMeasurement"] == "water_level"
    assert str(got["r4"]["MeasurementDateTime"]) == "2021-05-02 08:30:00" and got["r4"]["InputFileName"] == "b.csv"


def test_drop_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, "a")], "x int, Skip string")
    assert drop_columns(df).columns == ["x"]
    assert drop_columns(df, ["nope"]).columns == ["x", "Skip"]


def test_project_to_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project_to_target(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError):
        project_to_target(df, ["a", "z"])


CSV_SAMPLE = """#datatype,string,long,dateTime,dateTime,dateTime,double,string,string,string
,result,table,from,to,at,reading,unit,kind,place
,,0,2021-05-02T06:00:00Z,2021-05-02T07:00:00Z,2021-05-02T06:30:00Z,12.4,hectopascal,air_pressure_change,north_quay
,,0,2021-05-02T06:00:00Z,noon,2021-05-02T06:30:00Z,-3,centimetre,water_level,mill_weir
,,0,2021-05-02T07:00:00Z,2021-05-02T08:00:00Z,2021-05-02T07:30:00Z,n/a,centimetre,water_level,mill_weir
,,1,2021-05-02T08:00:00Z,2021-05-02T09:00:00Z,2021-05-02T08:30:00Z,40.5,centimetre,water_level,mill_weir
,,1,2021-05-02T08:00:00Z,2021-05-02T09:00:00Z,2021-05-02T08:30:00Z,1013.2,hectopascal,air_pressure,north_quay
"""


def _write_sample(spark, workdir):
    # The sample is text; Spark writes it so the folder is on the shared store.
    lines = spark.createDataFrame([(line,) for line in CSV_SAMPLE.strip().split("\n")],
                                  "value string")
    lines.coalesce(1).write.text(workdir)
    return workdir


def test_csv_positional_permissive(spark, workdir):
    path = _write_sample(spark, workdir)
    raw = read_sensor_csv(spark, path)
    out = raw.transform(clean_raw_data).orderBy("SensorMeasurement", "MeasurementDateTime")
    rows = out.collect()
    # header line skipped; the line of column names and 'n/a' go (no value)
    assert [r["SensorValue"] for r in rows] == [1013, 12, -3, 41]
    assert rows[0]["SensorMeasurement"] == "air_pressure"           # bound by position
    assert rows[2]["WindowAverageStopDateTime"] is None             # does not parse
    assert rows[0]["Id"] is None                                    # column absent in file


def test_stream_and_batch_agree(spark, workdir):
    path = _write_sample(spark, workdir)
    batch = read_sensor_csv(spark, path).transform(clean_raw_data)
    stream = stream_sensor_csv(spark, path).transform(clean_raw_data)
    got = []
    q = (stream.writeStream.trigger(availableNow=True)
         .option("checkpointLocation", workdir + "-ckpt")
         .foreachBatch(lambda b, i: got.extend(b.collect())).start())
    q.awaitTermination()
    key = lambda r: (r["SensorMeasurement"], str(r["MeasurementDateTime"]))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, batch.collect()), key=str)
    assert len(got) == 4 and sorted(got, key=key)[0]["SensorValue"] == 1013


def test_decimal_rounds_half_up_and_overflow(spark):
    df = spark.createDataFrame([("7.49",), ("7.5",), ("-7.5",), ("99999999999",), ("x",)],
                               "SensorValue string")
    out = [r[0] for r in parse_typed(df, sensor_schema()).collect()]
    assert out == [7, 8, -8, None, None]


def test_ingest_filter_reaches_csv_scan(spark, workdir):
    """Cleaning first, then file path and key: the not-null filter is pushed
    into the CSV scan (adding the key first would keep it above)."""
    from tests.conftest import SF001
    from tests.plans import plan_text
    from tidepool.plans import fixtures as fx
    from tidepool.sources.sensor import write_csv_feed
    from tidepool.streaming.pipeline import bronze_rows
    write_csv_feed(fx.raw(spark, SF001), workdir, files=2)
    plan = plan_text(bronze_rows(read_sensor_csv(spark, workdir)))
    assert "PushedFilters: [IsNotNull(SensorValue)]" in plan
    assert "BatchEvalPython" not in plan
