"""The two streaming hops of the sensor pipeline.

Both use ``foreachBatch`` into a :class:`ParquetTable` and run to drain
(``availableNow``), awaited, one checkpoint per hop:

* raw → bronze: CSV feed → cleaning → provenance → content key → append.
  A batch is one folder named by ``(query name @ checkpoint, batch id)`` that
  appears whole or not at all, so a batch replayed after a failure adds nothing,
  while a run from a *new* checkpoint (which restarts at batch 0) is not mistaken
  for a replay.
* bronze → silver: insert-only merge on the key, repeats inside a batch dropped
  too. Silver holds each reading (time, value, unit, measurement, location) once,
  whatever the batch size, and a replay from a fresh checkpoint adds nothing.

A streaming Parquet *file sink* is not used: it keeps its own batch log,
and with a new checkpoint it silently skips batches it thinks are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.cleaning import clean_raw_data
from tidepool.functions.keys import content_key
from tidepool.sources.sensor import (RAW_COLUMNS, SILVER_COLUMNS, SILVER_PARTITIONS,
                                     SKIP_COLUMNS, sensor_schema, stream_sensor_csv, with_provenance)
from tidepool.sources.table import OP_STREAM, ParquetTable

# The measurement content that identifies a reading.
INGEST_KEY_COLUMNS = ["MeasurementDateTime", "SensorValue", "SensorUnitDescription",
                      "SensorMeasurement", "SensorLocation"]

BRONZE_COLUMNS = [c for c in RAW_COLUMNS if c not in SKIP_COLUMNS] + ["InputFileName"]


def bronze_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    raw = sensor_schema(timestamp_type)
    fields = [raw[c] for c in BRONZE_COLUMNS if c != "InputFileName"]
    return T.StructType(fields + [T.StructField("InputFileName", T.StringType(), True)])


def bronze_rows(raw: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """Cleaning, then provenance, then the key: the not-null filter stays
    next to the scan so it is pushed down; key and file path come after."""
    cleaned = with_provenance(raw.transform(clean_raw_data))
    keyed = cleaned.withColumn("Id", content_key(*(key_columns or INGEST_KEY_COLUMNS)))
    return keyed.select(*BRONZE_COLUMNS)


def _app_id(query_name: str, checkpoint: str) -> str:
    """Identity of a stream for idempotent appends: batch ids restart with
    each new checkpoint, so the checkpoint is part of it."""
    return f"{query_name}@{checkpoint}"


def run_stream(df: DataFrame, name: str, checkpoint: str, handler, trigger: dict | None,
         await_done: bool) -> StreamingQuery:
    w = (df.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint)
         .foreachBatch(handler))
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    if await_done:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return q


def ingest_raw_to_bronze(spark: SparkSession, source_dir: str, bronze: ParquetTable,
                         checkpoint: str, schema: T.StructType | None = None,
                         key_columns: list[str] | None = None,
                         max_files_per_trigger: int | None = None,
                         query_name: str = "raw_to_bronze",
                         trigger: dict | None = None,
                         await_done: bool = True,
                         timestamp_format: str | None = None) -> StreamingQuery:
    """Raw CSV feed → bronze table, appending each micro-batch once."""
    raw = stream_sensor_csv(spark, source_dir, schema or sensor_schema(),
                            max_files_per_trigger=max_files_per_trigger,
                            timestamp_format=timestamp_format)
    rows = bronze_rows(raw, key_columns)

    def append(batch: DataFrame, batch_id: int) -> None:
        bronze.append(batch, operation=OP_STREAM,
                      txn=(_app_id(query_name, checkpoint), batch_id))

    return run_stream(rows, query_name, checkpoint, append, trigger, await_done)


def merge_bronze_to_silver(bronze: ParquetTable, silver: ParquetTable, checkpoint: str,
                           max_files_per_trigger: int | None = None,
                           query_name: str = "bronze_to_silver",
                           trigger: dict | None = None,
                           await_done: bool = True,
                           key_implies_partition: bool = False,
                           key_implies: list[str] | None = None) -> StreamingQuery:
    """Bronze stream → silver, insert-only merge on the key per micro-batch.

    Set ``key_implies_partition`` / ``key_implies`` when the key hashes
    those columns (as ``INGEST_KEY_COLUMNS`` do): each batch then probes only
    the silver partitions it touches, within its own time range."""
    src = bronze.stream(max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Bounds and keys are read from the batch's files by column, whole rows once, for the insert: a copy of the
        # batch (persist) cost more than these reads.
        silver.merge_insert_only(batch, txn=(_app_id(query_name, checkpoint), batch_id),
                                 key_implies_partition=key_implies_partition,
                                 key_implies=key_implies, once=True)

    return run_stream(src, query_name, checkpoint, merge, trigger, await_done)


def copy_stream(source: ParquetTable, target: ParquetTable, checkpoint: str,
                max_files_per_trigger: int | None = None,
                query_name: str = "table_copy", trigger: dict | None = None,
                await_done: bool = True) -> StreamingQuery:
    """A table read as a stream, appended to another table."""
    src = source.stream(max_files_per_trigger)

    def append(batch: DataFrame, batch_id: int) -> None:
        target.append(batch, operation=OP_STREAM,
                      txn=(_app_id(query_name, checkpoint), batch_id))

    return run_stream(src, query_name, checkpoint, append, trigger, await_done)



def run_sensor_pipeline(spark: SparkSession, source_dir: str, root: str,
                        start_over: bool = False, schema: T.StructType | None = None,
                        timestamp_format: str | None = None,
                        max_files_per_trigger: int | None = None,
                        trigger: dict | None = None,
                        cluster: bool = False) -> ParquetTable:
    """The whole incremental job: raw CSV → bronze → silver, then clustering.

    Layout under ``root``: ``bronze/``, ``silver/`` (partitioned by location
    and measurement) and ``_checkpoints/{raw_to_bronze,bronze_to_silver}``.
    Each call processes only files not seen before (run to drain, awaited).

    ``start_over=True`` removes checkpoints *and* both tables together, so
    the replay starts from empty targets; removing only the checkpoints
    would re-ingest into a bronze that already holds the rows.
    ``cluster=True`` ends with ``OPTIMIZE … ZORDER BY (MeasurementDateTime)``,
    a full rewrite of silver. It is off by default: every merge batch already
    writes files spanning only that batch's time window, so appended data
    stays clustered by time; re-cluster on a schedule instead, or only some
    partitions with ``silver.cluster_by(..., where=...)``.
    """
    from tidepool.sources import files

    root = root.rstrip("/")
    bronze_root, silver_root = f"{root}/bronze", f"{root}/silver"
    ckpt_raw = f"{root}/_checkpoints/raw_to_bronze"
    ckpt_silver = f"{root}/_checkpoints/bronze_to_silver"
    if start_over:
        for path in (ckpt_raw, ckpt_silver, bronze_root, silver_root):
            files.delete(spark, path)
    raw_schema = schema or sensor_schema()
    ts_type = raw_schema["MeasurementDateTime"].dataType
    b_schema = bronze_schema(ts_type)
    if ParquetTable.exists(spark, bronze_root):
        bronze = ParquetTable.open(spark, bronze_root)
    else:
        bronze = ParquetTable.create(spark, bronze_root, b_schema)
    if ParquetTable.exists(spark, silver_root):
        silver = ParquetTable.open(spark, silver_root)
    else:
        silver = ParquetTable.create(spark, silver_root,
                                     T.StructType([b_schema[c] for c in SILVER_COLUMNS]),
                                     SILVER_PARTITIONS)
    ingest_raw_to_bronze(spark, source_dir, bronze, ckpt_raw, schema=raw_schema,
                         max_files_per_trigger=max_files_per_trigger,
                         timestamp_format=timestamp_format, trigger=trigger)
    # The ingest key hashes location, measurement and time, so each batch probes
    # only the silver partitions it touches, within its own time range.
    merge_bronze_to_silver(bronze, silver, ckpt_silver,
                           max_files_per_trigger=max_files_per_trigger, trigger=trigger,
                           key_implies_partition=True, key_implies=["MeasurementDateTime"])
    if cluster:
        silver.cluster_by("MeasurementDateTime")
    return silver
