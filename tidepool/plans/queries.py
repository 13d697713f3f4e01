"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
writes from them), never a fixed made-up input.

Queries that exercise writers or streams write under the session's shared
checkpoint folder (``tidepool.session.work_path``) and return a lazy read of
what they wrote.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.casting import parse_typed
from tidepool.functions import keys
from tidepool.functions.cleaning import (clean_raw_data, drop_columns, filter_not_null,
                                         project_to_target)
from tidepool.functions.predicates import ts_literal
from tidepool.operators import access, changes, merge, mutate
from tidepool.plans import fixtures as fx
from tidepool.plans.registry import REGISTRY, query  # noqa: F401  (REGISTRY: for importers)
from tidepool.session import work_path
from tidepool.sources import files
from tidepool.sources.sensor import (CSV_TIME_FORMAT, SILVER_COLUMNS, raw_rows, sensor_schema,
                                     source_inventory, with_provenance, write_csv_feed)
from tidepool.sources.table import ParquetTable
from tidepool.streaming.pipeline import (bronze_schema, copy_stream, ingest_raw_to_bronze,
                                         merge_bronze_to_silver)


# --- A, C, I: scans, projections, filters, scalar functions --------------

@query("scan_all")
def scan_all(spark, d):
    """``SELECT *`` of the events table."""
    return fx.events(spark, d)


@query("sensor_schema_cast")
def sensor_schema_cast(spark, d):
    """Text cells re-parsed into the feed's typed schema (bad cells → NULL)."""
    ev = fx.events(spark, d)
    ts_text = F.col("ts").cast("string")
    text = ev.select(
        "event_id",
        F.lit("").alias("Skip"), F.col("event_type").alias("SkipResult"), F.lit("0").alias("SkipTable"),
        F.lit("unit").alias("SensorUnitDescription"),
        F.concat(F.lit("loc_"), (F.col("user_id") % 4).cast("string")).alias("SensorLocation"),
        F.col("event_id").cast("string").alias("Id"),
        F.when(F.col("event_id") % 6 == 0, F.substring(ts_text, 1, 10)).otherwise(ts_text)
         .alias("WindowAverageStartDateTime"),
        F.when(F.col("event_id") % 9 == 0, F.lit("not a time")).otherwise(ts_text)
         .alias("MeasurementDateTime"),
        F.when(F.col("event_id") % 5 == 0, F.regexp_replace(ts_text, " ", ""))
         .otherwise(ts_text).alias("WindowAverageStopDateTime"),
        F.when(F.col("event_id") % 13 == 0, F.lit("abc"))
         .when(F.col("event_id") % 17 == 0, F.lit("99999999999"))
         .otherwise(F.col("value").cast("string")).alias("SensorValue"),
        F.col("event_type").alias("SensorMeasurement"))
    return parse_typed(text, sensor_schema(T.TimestampNTZType()))


@query("filter_not_null")
def q_filter_not_null(spark, d):
    return filter_not_null(fx.sensor(spark, d))


@query("drop_columns")
def q_drop_columns(spark, d):
    return drop_columns(fx.raw(spark, d))


@query("clean_raw")
def clean_raw(spark, d):
    return fx.raw(spark, d).transform(clean_raw_data)


@query("assign_id")
def assign_id(spark, d):
    keyed = keys.assign_id(fx.sensor(spark, d, keep_event_id=True),
                           ["MeasurementDateTime", "SensorValue", "SensorMeasurement", "SensorLocation"])
    return keyed.select("event_id", "Id")


@query("file_provenance")
def file_provenance(spark, d):
    rows = with_provenance(fx.events(spark, d))
    return rows.select("event_id", F.substring_index("InputFileName", "/", -1).alias("InputFileName"))


@query("project_to_target")
def q_project_to_target(spark, d):
    ev = fx.events(spark, d)
    bronze = clean_raw_data(raw_rows(ev, file_column="InputFileName"))
    return project_to_target(bronze, SILVER_COLUMNS)


@query("filter_partition_eq")
def filter_partition_eq(spark, d):
    return fx.clean(spark, d).filter(
        (F.col("SensorMeasurement") == "view") & (F.col("SensorLocation") == "loc_1"))


@query("count_rows")
def count_rows(spark, d):
    return fx.clean(spark, d).agg(F.count(F.lit(0)).alias("row_count"))


# --- D: merge ------------------------------------------------------------

@query("merge_insert_only")
def merge_insert_only(spark, d):
    t = fx.target_rows(spark, d).select(*fx.SILVER)
    u = fx.update_rows(spark, d).select(*fx.SILVER)
    return merge.merge_insert_only(t, u, "Id")


@query("merge_upsert")
def merge_upsert(spark, d):
    t = fx.target_rows(spark, d).select(*fx.SILVER)
    u = fx.update_rows(spark, d).select(*fx.SILVER)
    return merge.merge_upsert(t, u, "Id")


@query("incremental_by_max_ts")
def incremental_by_max_ts(spark, d):
    c = fx.clean(spark, d)
    target = c.filter(F.col("MeasurementDateTime") < ts_literal(fx.TARGET_BEFORE))
    return merge.incremental_by_max_ts(c, target, "MeasurementDateTime")


# --- J: mutation ---------------------------------------------------------

@query("delete_where")
def delete_where(spark, d):
    return mutate.delete_where(fx.sensor(spark, d), fx.DELETE_PRED)


@query("replace_where")
def replace_where(spark, d):
    c = fx.clean(spark, d)
    new = fx.update_rows(spark, d).select(*fx.SILVER).filter(F.expr(fx.PARTITION_PRED))
    return mutate.replace_where(c, new, fx.PARTITION_PRED)


@query("expire_rows")
def expire_rows(spark, d):
    return changes.expire_rows(fx.clean(spark, d), "MeasurementDateTime",
                               fx.EXPIRE_AS_OF, fx.EXPIRE_DAYS)


@query("assign_identity")
def assign_identity(spark, d):
    return mutate.assign_identity(fx.clean(spark, d, True), column="seq_id",
                                  order_by=["event_id"])


POLICY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("insert_timestamp", T.TimestampNTZType()),
])


@query("insert_defaults")
def insert_defaults(spark, d):
    """``description DEFAULT 'none'``: filled when omitted, explicit NULL kept."""
    c = fx.table_of(spark, d, "customer")
    defaults = {"description": F.lit("none"), "insert_timestamp": ts_literal(fx.INSERT_AS_OF)}
    omitted = c.filter(F.col("c_custkey") % 4 != 0).select("c_custkey", F.col("c_name").alias("name"))
    explicit_null = c.filter(F.col("c_custkey") % 4 == 0).select(
        "c_custkey", F.col("c_name").alias("name"), F.lit(None).cast("string").alias("description"))
    return _policies([omitted, explicit_null], defaults)


def _policies(batches, defaults):
    """The inserts in order, each numbered by customer: ``id`` runs over all of them."""
    shaped = [mutate.apply_defaults(b.withColumn("_batch", F.lit(i)), POLICY_SCHEMA, defaults, keep=["_batch", "c_custkey"])
              for i, b in enumerate(batches)]
    rows = reduce(DataFrame.unionByName, shaped)
    return mutate.assign_identity(rows, "id", order_by=["_batch", "c_custkey"]).select(*POLICY_SCHEMA.names)


@query("insert_partial")
def insert_partial(spark, d):
    """``name DEFAULT 'noname'``; three inserts with different column lists."""
    c = fx.table_of(spark, d, "customer")
    defaults = {"name": F.lit("noname"), "insert_timestamp": ts_literal(fx.INSERT_AS_OF)}
    k = F.col("c_custkey") % 3
    name, text = F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description")
    return _policies([c.filter(k == 0).select("c_custkey", name, text), c.filter(k == 1).select("c_custkey", text),
                      c.filter(k == 2).select("c_custkey", name)], defaults)


@query("insert_sequence")
def insert_sequence(spark, d):
    """Three inserts into one table: each continues the identity of the one before."""
    t = ParquetTable.create(spark, work_path(spark, "policies"), POLICY_SCHEMA, key=("id",))
    c = fx.table_of(spark, d, "customer")
    defaults = {"name": F.lit("noname"), "description": F.lit("none"),
                "insert_timestamp": F.expr("cast(current_timestamp() as timestamp_ntz)")}
    k = F.col("c_custkey") % 3
    name, text = F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description")
    for i, cols in enumerate([[name, text], [text], [name]]):
        t.insert(c.filter(k == i).select("c_custkey", *cols), defaults, identity="id", order_by=["c_custkey"])
    return t.read().select("id", "name", "description", F.col("insert_timestamp").isNotNull().alias("has_time"))


@query("change_feed")
def change_feed(spark, d):
    t = fx.target_rows(spark, d)
    even = F.col("event_id") % 2 == 0
    after_t = (t.filter(F.col("event_id") % 5 != 0)
                .withColumn("SensorValue",
                            F.when(even, (F.col("SensorValue") + 1).cast(T.DecimalType(10, 0)))
                             .otherwise(F.col("SensorValue"))))
    after_u = fx.update_rows(spark, d).filter(F.col("event_id") % 3 == 1)
    before = t.select(*fx.SILVER)
    after = after_t.select(*fx.SILVER).unionByName(after_u.select(*fx.SILVER))
    return changes.change_feed(before, after, "Id")


@query("evolve_append")
def evolve_append(spark, d):
    """A table written without the unit column, then an append that brings
    it (``mergeSchema``): old rows read it as NULL."""
    old = fx.target_rows(spark, d).select(*fx.SILVER).drop("SensorUnitDescription")
    t = ParquetTable.create_as(spark, work_path(spark, "evolve"), old)
    t.append(fx.update_rows(spark, d).select(*fx.SILVER), merge_schema=True)
    return t.read().select(*fx.SILVER)


# --- M: access report ----------------------------------------------------

def _entities(spark, d):
    return access.entity_set(fx.membership(spark, d), fx.ENTITY)


@query("groups_of_user")
def groups_of_user(spark, d):
    return access.groups_of_user(fx.membership(spark, d), fx.ENTITY)


@query("entity_closure")
def entity_closure(spark, d):
    return _entities(spark, d)


@query("catalog_access")
def catalog_access(spark, d):
    return access.catalog_access(fx.catalog_privileges(spark, d), _entities(spark, d))


@query("schema_access_explicit")
def schema_access_explicit(spark, d):
    return access.schema_access_explicit(fx.schema_privileges(spark, d), _entities(spark, d))


@query("schema_access_inherited")
def schema_access_inherited(spark, d):
    return access.schema_access_inherited(fx.schema_privileges(spark, d), _entities(spark, d))


@query("table_access")
def table_access(spark, d):
    e = _entities(spark, d)
    return access.table_access(access.table_privileges(fx.schema_privileges(spark, d), fx.tables(spark, d), e), e)


@query("owned_tables")
def owned_tables(spark, d):
    e = _entities(spark, d)
    return access.owned_tables(fx.tables(spark, d, owners=e), e)


@query("stale_tables")
def stale_tables(spark, d):
    e = _entities(spark, d)
    return access.stale_tables(fx.tables(spark, d, owners=e), e,
                               fx.ACCESS_AS_OF, fx.STALE_DAYS)


@query("expand_privileges")
def expand_privileges(spark, d):
    return fx.schema_privileges(spark, d)


# --- B, J: tables written by Spark from the test tables -------------------

PARTS = ["SensorLocation", "SensorMeasurement"]
TOMBSTONE_PRED = "event_id % 11 = 0"


def _clean_table(spark, d, label: str, partition_by=PARTS):
    """``clean`` (with ``event_id``) written as a partitioned table (CTAS)."""
    return ParquetTable.create_as(spark, work_path(spark, label),
                                  fx.clean(spark, d, keep_event_id=True), partition_by)


@query("ctas_copy")
def ctas_copy(spark, d):
    return _clean_table(spark, d, "ctas", partition_by=()).read().select(*fx.SILVER)


@query("ctas_partitioned")
def ctas_partitioned(spark, d):
    return _clean_table(spark, d, "ctas-part").read().select(*fx.SILVER)


@query("soft_delete_read")
def soft_delete_read(spark, d):
    t = _clean_table(spark, d, "soft-delete")
    t.delete(TOMBSTONE_PRED)
    return t.read().select(*fx.SILVER)


@query("soft_delete_reinsert")
def soft_delete_reinsert(spark, d):
    """Rows deleted, then merged in again (insert-only) with new values: the new rows show."""
    t = _clean_table(spark, d, "reinsert")
    t.delete(TOMBSTONE_PRED)
    again = fx.clean(spark, d, True).withColumn("SensorValue", (F.col("SensorValue") + 1).cast(T.DecimalType(10, 0)))
    t.merge_insert_only(again)
    return t.read().select(*fx.SILVER)


@query("soft_delete_null_partition")
def soft_delete_null_partition(spark, d):
    """A table partitioned by the value, NULL for a seventh of the rows; deletes there and elsewhere."""
    t = ParquetTable.create_as(spark, work_path(spark, "null-part"), fx.sensor(spark, d, keep_event_id=True), ["SensorValue"])
    t.delete("SensorValue IS NULL AND event_id % 2 = 0")
    t.delete(TOMBSTONE_PRED)
    return t.read().select(*fx.SILVER)


@query("replace_from_itself")
def replace_from_itself(spark, d):
    """``CREATE OR REPLACE TABLE t AS SELECT … FROM t``."""
    t = _clean_table(spark, d, "itself")
    t = ParquetTable.create_as(spark, t.root, t.read().filter("event_id % 3 = 0"), PARTS, replace=True)
    return t.read().select(*fx.SILVER)


@query("table_upsert")
def table_upsert(spark, d):
    t = ParquetTable.create_as(spark, work_path(spark, "upsert"), fx.target_rows(spark, d).select(*fx.SILVER), PARTS)
    t.upsert(fx.update_rows(spark, d).select(*fx.SILVER))
    return t.read()


@query("table_delete_hard")
def table_delete_hard(spark, d):
    """A delete, then the rows removed from the files."""
    t = _clean_table(spark, d, "hard-delete")
    t.delete(fx.DELETE_PRED)
    t.purge()
    return t.base().select(*fx.SILVER)


@query("table_changes_since")
def table_changes_since(spark, d):
    """Changes since a snapshot of ``T`` after a delete and an upsert of ``U``."""
    t = ParquetTable.create_as(spark, work_path(spark, "changes"), fx.target_rows(spark, d), PARTS)
    before = t.snapshot()
    t.delete("event_id % 5 = 0")
    t.upsert(fx.update_rows(spark, d).filter("event_id % 5 != 0"))
    return t.changes_since(before).select(*fx.SILVER, "_change_type")


@query("table_files")
def table_files(spark, d):
    """Per partition of a written table, from the file listing: whether the bytes listed are those
    of the files that hold the partition's rows, and the rows."""
    t = _clean_table(spark, d, "files")
    listed = t.files().groupBy(*PARTS).agg(F.sum("bytes").alias("listed"))
    held = (t.base_files().groupBy(*PARTS).agg(F.sum("size").alias("held"), F.sum("rows").alias("num_rows")))
    return listed.join(held, PARTS).select(*PARTS, "num_rows", (F.col("listed") == F.col("held")).alias("same_bytes"))


@query("purge_partitions")
def purge_partitions(spark, d):
    t = _clean_table(spark, d, "purge")
    t.delete(TOMBSTONE_PRED)
    t.purge("SensorLocation = 'loc_1'")
    return t.read().select(*fx.SILVER)


@query("shallow_snapshot")
def shallow_snapshot(spark, d):
    t = _clean_table(spark, d, "shallow")
    snap = t.snapshot()
    t.delete(TOMBSTONE_PRED)
    t.purge()
    return snap.read().select(*fx.SILVER)


@query("deep_copy")
def deep_copy(spark, d):
    t = _clean_table(spark, d, "deep-src")
    clone = t.deep_clone(work_path(spark, "deep-clone"))
    t.delete(TOMBSTONE_PRED)
    return clone.read().select(*fx.SILVER)


@query("table_like")
def table_like(spark, d):
    t = _clean_table(spark, d, "like")
    t.delete(TOMBSTONE_PRED)
    return t.register(f"tidepool_like_{uuid.uuid4().hex[:12]}").select(*fx.SILVER)


@query("cluster_by_time")
def q_cluster_by_time(spark, d):
    t = _clean_table(spark, d, "cluster")
    t.cluster_by("MeasurementDateTime")
    return t.read().select(*fx.SILVER)


@query("table_detail")
def table_detail(spark, d):
    t = _clean_table(spark, d, "detail")
    return t.partition_counts()


@query("operation_history")
def operation_history(spark, d):
    """Versions and operations after CTAS, delete, replace, purge, optimize."""
    t = _clean_table(spark, d, "history")
    t.delete(TOMBSTONE_PRED)
    new = fx.update_rows(spark, d).filter(F.expr(fx.PARTITION_PRED))
    t.replace_where(fx.PARTITION_PRED, new)
    t.purge("SensorLocation = 'loc_1'")
    t.cluster_by("MeasurementDateTime")
    return t.history().select("version", "operation",
                              F.when(F.col("operation") == "DELETE", F.col("num_deleted_rows"))
                               .otherwise(F.col("num_output_rows")).alias("num_rows"))


@query("source_inventory")
def q_source_inventory(spark, d):
    inv = source_inventory(spark, d, glob="*.parquet")
    return inv.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                      F.col("length").alias("size_bytes"))


# --- A, B, K: streaming ---------------------------------------------------

FEED_FILES, FEED_FILE_BYTES = 4, 32 << 20  # least number of feed files; Parquet bytes of ``events`` for each


def feed_files(spark, d, share: float = 1.0) -> int:
    """Files for a feed written from a share of ``events``: by its size, a multiple of ``FEED_FILES``."""
    fours = share * files.total_bytes(spark, f"{d}/events.parquet") / (FEED_FILES * FEED_FILE_BYTES)
    return FEED_FILES * max(1, math.ceil(fours))


def _feed(spark, d):
    """The raw CSV feed, written by Spark from ``events``; (folder, number of files)."""
    path, n = work_path(spark, "feed"), feed_files(spark, d)
    write_csv_feed(fx.raw(spark, d), path, files=n)
    return path, n


def _bronze(spark, label: str):
    return ParquetTable.create(spark, work_path(spark, label),
                               bronze_schema(T.TimestampNTZType()))


def _ingest(spark, feed, bronze, checkpoint):
    schema = sensor_schema(T.TimestampNTZType())
    ingest_raw_to_bronze(spark, feed, bronze, checkpoint, schema=schema,
                         timestamp_format=CSV_TIME_FORMAT)


BRONZE_OUT = ["WindowAverageStartDateTime", "WindowAverageStopDateTime", "MeasurementDateTime",
              "SensorValue", "SensorUnitDescription", "SensorMeasurement", "SensorLocation", "Id"]


def _from_feed(feed):
    """Whether ``InputFileName`` is a file of the feed (the files' own names are drawn by Spark)."""
    return F.col("InputFileName").contains(f"{feed.rsplit('/', 1)[1]}/part-").alias("from_feed")


@query("stream_csv_ingest")
def stream_csv_ingest(spark, d):
    feed, _ = _feed(spark, d)
    bronze = _bronze(spark, "bronze")
    _ingest(spark, feed, bronze, work_path(spark, "ckpt-raw"))
    return bronze.read().select(*BRONZE_OUT, _from_feed(feed))


@query("stream_rerun_noop")
def stream_rerun_noop(spark, d):
    """A second run on the same checkpoint finds no new file and adds nothing."""
    feed, _ = _feed(spark, d)
    bronze = _bronze(spark, "bronze-rerun")
    ckpt = work_path(spark, "ckpt-raw")
    _ingest(spark, feed, bronze, ckpt)
    _ingest(spark, feed, bronze, ckpt)
    return bronze.read().select(*BRONZE_OUT, _from_feed(feed))


def _silver(spark, label: str):
    b = bronze_schema(T.TimestampNTZType())
    schema = T.StructType([b[c] for c in SILVER_COLUMNS])
    return ParquetTable.create(spark, work_path(spark, label), schema, PARTS)


@query("stream_replay_idempotent")
def stream_replay_idempotent(spark, d):
    """Bronze → silver, then a replay from a fresh checkpoint: content keys
    make the insert-only merge add nothing the second time."""
    feed, n = _feed(spark, d)
    bronze = _bronze(spark, "bronze-replay")
    _ingest(spark, feed, bronze, work_path(spark, "ckpt-raw"))
    silver = _silver(spark, "silver-replay")
    # The ingest key hashes location, measurement (the silver partitions) and time.
    implied = dict(key_implies_partition=True, key_implies=["MeasurementDateTime"])
    for checkpoint in ("ckpt-a", "ckpt-b"):
        merge_bronze_to_silver(bronze, silver, work_path(spark, checkpoint), max_files_per_trigger=n // 2, **implied)
    return silver.read().select(*[c for c in BRONZE_OUT if c in SILVER_COLUMNS], _from_feed(feed))


@query("stream_repeated_readings")
def stream_repeated_readings(spark, d):
    """A feed that holds readings twice, in one file and across files: silver is the same for
    triggers of a fourth, of half and of all bronze files (column ``files_per_trigger``: 1, 2 and 0)."""
    rows = fx.raw(spark, d)
    feed, n = work_path(spark, "feed"), feed_files(spark, d, 2.0)
    write_csv_feed(rows.unionByName(rows.filter("SensorMeasurement != 'view'")), feed, files=n)
    write_csv_feed(rows.filter("SensorLocation = 'loc_1'"), feed, files=n // FEED_FILES)
    bronze = _bronze(spark, "bronze-repeats")
    _ingest(spark, feed, bronze, work_path(spark, "ckpt-raw"))
    out = []
    for quarters in (1, 2, 0):
        silver = _silver(spark, f"silver-repeats-{quarters}")
        merge_bronze_to_silver(bronze, silver, work_path(spark, "ckpt-s"),
                               max_files_per_trigger=quarters * n // FEED_FILES or None)
        out.append(silver.read().select(*[c for c in BRONZE_OUT if c in SILVER_COLUMNS],
                                        F.lit(quarters).alias("files_per_trigger")))
    return reduce(DataFrame.unionByName, out)


@query("stream_merge_silver")
def stream_merge_silver(spark, d):
    """Silver seeded with ``T``; the bronze stream carries ``U`` in several
    files; each micro-batch is merged insert-only on ``Id``."""
    silver_cols = fx.SILVER
    silver = ParquetTable.create(spark, work_path(spark, "silver"),
                                 fx.target_rows(spark, d).select(*silver_cols).schema, PARTS)
    silver.append(fx.target_rows(spark, d).select(*silver_cols))
    bronze = ParquetTable.create(spark, work_path(spark, "bronze-u"),
                                 fx.update_rows(spark, d).select(*silver_cols).schema)
    # One append spread round-robin over several files: several micro-batches.
    n = feed_files(spark, d)
    bronze.append(fx.update_rows(spark, d).select(*silver_cols).repartition(n))
    merge_bronze_to_silver(bronze, silver, work_path(spark, "ckpt-silver"), max_files_per_trigger=n // 2)
    return silver.read()


@query("stream_table_read")
def stream_table_read(spark, d):
    """A table read as a stream (every file once) into another table."""
    src = _clean_table(spark, d, "stream-src")
    dst = ParquetTable.create(spark, work_path(spark, "stream-dst"), src.schema, PARTS)
    copy_stream(src, dst, work_path(spark, "ckpt-copy"), max_files_per_trigger=8)
    return dst.read().select(*fx.SILVER)


# The queries over catalog tables register themselves; they share the feed helpers above.
from tidepool.plans import catalog_queries  # noqa: E402, F401
