"""The sensor feed: its positional CSV schema, readers, provenance and
source inventory, plus the derivation of sensor rows from ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw feed's columns, in file order (CSV binds by position).
RAW_COLUMNS = [
    "Skip", "SkipResult", "SkipTable",
    "WindowAverageStartDateTime", "WindowAverageStopDateTime",
    "MeasurementDateTime", "SensorValue", "SensorUnitDescription",
    "SensorMeasurement", "SensorLocation", "Id",
]
# Header junk columns removed by the cleaning step.
SKIP_COLUMNS = ["Skip", "SkipResult", "SkipTable"]
# The silver table's columns and partition columns.
SILVER_COLUMNS = [
    "MeasurementDateTime", "SensorValue", "SensorUnitDescription",
    "SensorMeasurement", "SensorLocation", "Id", "InputFileName",
]
SILVER_PARTITIONS = ["SensorLocation", "SensorMeasurement"]

_TIME_COLUMNS = {"WindowAverageStartDateTime", "WindowAverageStopDateTime",
                 "MeasurementDateTime"}

# Text layout used when the feed is written as CSV; it keeps microseconds.
CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def sensor_schema(timestamp_type: T.DataType | None = None,
                  precision: int = 10, scale: int = 0,
                  with_id: bool = True) -> T.StructType:
    """The raw feed schema: every field nullable, value ``decimal(10,0)``.

    ``timestamp_type`` defaults to ``TimestampType``; pass
    ``TimestampNTZType()`` to keep wall-clock times without a zone.
    """
    ts_type = timestamp_type or T.TimestampType()
    fields = []
    for name in RAW_COLUMNS:
        if not with_id and name == "Id":
            continue
        if name in _TIME_COLUMNS:
            dt: T.DataType = ts_type
        elif name == "SensorValue":
            dt = T.DecimalType(precision, scale)
        else:
            dt = T.StringType()
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)


def _csv_reader(reader, schema: T.StructType, timestamp_format: str | None = None):
    r = (reader.format("csv")
         .option("header", "true")
         .option("mode", "PERMISSIVE")
         .schema(schema))
    if timestamp_format:
        r = (r.option("timestampFormat", timestamp_format)
              .option("timestampNTZFormat", timestamp_format))
    return r


def read_sensor_csv(spark: SparkSession, path: str,
                    schema: T.StructType | None = None,
                    timestamp_format: str | None = None) -> DataFrame:
    """Batch read of the CSV feed: header skipped, cells bound by position,
    cells that fail their cast become NULL and the row is kept."""
    return _csv_reader(spark.read, schema or sensor_schema(), timestamp_format).load(path)


def stream_sensor_csv(spark: SparkSession, path: str,
                      schema: T.StructType | None = None,
                      max_files_per_trigger: int | None = None,
                      timestamp_format: str | None = None) -> DataFrame:
    """Streaming read of the CSV feed; each file is taken once per checkpoint."""
    reader = _csv_reader(spark.readStream, schema or sensor_schema(), timestamp_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def input_file_path() -> Column:
    """Source file of each row (replaces ``input_file_name()``; unlike it,
    the metadata column does not block filter pushdown)."""
    return F.col("_metadata.file_path")


def with_provenance(df: DataFrame, column: str = "InputFileName") -> DataFrame:
    return df.withColumn(column, input_file_path())


def source_inventory(spark: SparkSession, path: str,
                     glob: str | None = None) -> DataFrame:
    """Files under ``path`` with size and modification time.

    Uses the ``binaryFile`` source with ``content`` pruned, so no file body
    is read; the listing itself is distributed for large folders.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


# --- sensor rows derived from the driver's ``events`` table -------------

def sensor_rows(events: DataFrame, keep_event_id: bool = False,
                file_column: str | None = None) -> DataFrame:
    """``events`` seen as silver-shaped sensor rows (FIXTURES.md §1).

    Every 7th event gets a NULL value so that the cleaning step has work.
    The value cast is ``try_cast``: an out-of-range value becomes NULL (and
    is cleaned away) under ANSI mode too, instead of failing the job.
    ``file_column`` adds the source file's name (``events`` must be a scan).
    """
    cols = [
        F.md5(F.concat_ws("|", F.col("event_id").cast("string"),
                          F.col("event_type"))).alias("Id"),
        F.col("ts").alias("MeasurementDateTime"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None))
         .otherwise(F.col("value").try_cast(T.DecimalType(10, 0)))
         .alias("SensorValue"),
        F.lit("unit").alias("SensorUnitDescription"),
        F.col("event_type").alias("SensorMeasurement"),
        F.concat(F.lit("loc_"), (F.col("user_id") % 4).cast("string"))
         .alias("SensorLocation"),
    ]
    if keep_event_id:
        cols = [F.col("event_id")] + cols
    if file_column:
        cols.append(F.col("_metadata.file_name").alias(file_column))
    return events.select(*cols)


def raw_rows(events: DataFrame, keep_event_id: bool = False,
             file_column: str | None = None) -> DataFrame:
    """``events`` in the raw feed's 11-column layout (typed)."""
    s = sensor_rows(events, keep_event_id=True, file_column=file_column)
    cols = [
        F.lit(None).cast("string").alias("Skip"),
        F.lit(None).cast("string").alias("SkipResult"),
        F.lit("0").alias("SkipTable"),
        (F.col("MeasurementDateTime") - F.expr("INTERVAL 1 HOUR"))
        .alias("WindowAverageStartDateTime"),
        F.col("MeasurementDateTime").alias("WindowAverageStopDateTime"),
        "MeasurementDateTime", "SensorValue", "SensorUnitDescription",
        "SensorMeasurement", "SensorLocation", "Id",
    ]
    if keep_event_id:
        cols = ["event_id"] + cols
    if file_column:
        cols.append(file_column)
    return s.select(*cols)


def write_csv_feed(df: DataFrame, path: str, files: int = 4,
                   mode: str = "append") -> None:
    """Write raw-layout rows as a CSV feed with a header line per file.

    ``files`` output files, filled round-robin (no key, so a hot key cannot
    pile into one file).
    """
    out = df.select(*[c for c in RAW_COLUMNS if c in df.columns])
    (out.repartition(files)
        .write.mode(mode)
        .option("header", "true")
        .option("timestampFormat", CSV_TIME_FORMAT)
        .option("timestampNTZFormat", CSV_TIME_FORMAT)
        .csv(path))
