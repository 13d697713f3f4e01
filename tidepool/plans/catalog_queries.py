"""Registered queries over tables that Spark's catalog holds by name.

Every query makes databases of its own, with unique names and folders under the session's shared
checkpoint folder. Statements are one per table; rows move only in Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.predicates import is_true
from tidepool.operators import access, soft_delete
from tidepool.plans import fixtures as fx
from tidepool.plans.queries import (BRONZE_OUT, CSV_TIME_FORMAT, PARTS, _bronze, _feed, _from_feed, feed_files)
from tidepool.plans.registry import query
from tidepool.session import work_path
from tidepool.sources import catalog
from tidepool.sources.sensor import read_sensor_csv, sensor_schema, source_inventory
from tidepool.streaming.interval import Watch
from tidepool.streaming.pipeline import ingest_raw_to_bronze
from tidepool.streaming.sql_sink import merge_stream_sql

SESSION_CATALOG = "spark_catalog"   # Spark's own; see README for a second one


def _database(spark, label: str, prefix: str | None = None) -> str:
    name = f"{prefix or 'tidepool_' + uuid.uuid4().hex[:12]}_{label}"
    catalog.create_database(spark, name, work_path(spark, f"db-{label}"))
    return name


# --- A7, B7, J10, J16: tables by qualified name ------------------------------------

@query("catalog_migrate")
def catalog_migrate(spark, d):
    """A partitioned table copied between databases by three-part names, the old database then
    dropped with its files; the copy's rows, and whether the old table was marked as moved."""
    old, new = _database(spark, "old"), _database(spark, "new")
    source, target = (f"{SESSION_CATALOG}.{db}.sensors" for db in (old, new))
    catalog.create_table_as(spark, source, fx.clean(spark, d), PARTS)
    catalog.migrate(spark, source, target)
    marked = catalog.table_properties(spark, [source]).filter(F.col("key") == catalog.UPGRADED_TO).first()
    catalog.drop_database(spark, old)
    return spark.sql(f"SELECT {', '.join(fx.SILVER)}, {catalog.text(marked['value'])} = {catalog.text(target)} AS marked "
                     f"FROM {target}")


@query("ctas_location")
def ctas_location(spark, d):
    """An external table by CTAS at a location; its name is dropped, its files are read again."""
    path = work_path(spark, "external")
    name = f"{_database(spark, 'external')}.sensors"
    catalog.create_table_as(spark, name, fx.clean(spark, d), PARTS, location=path)
    catalog.drop_table(spark, name)
    return spark.read.schema(fx.clean(spark, d).schema).parquet(path).select(*fx.SILVER)


@query("table_like_location")
def table_like_location(spark, d):
    """``CREATE TABLE … LIKE … COPY LOCATION``: a second name over the same files, which stays
    when the first is dropped."""
    db = _database(spark, "like")
    catalog.create_table_as(spark, f"{db}.sensors", fx.clean(spark, d), PARTS, location=work_path(spark, "like-files"))
    catalog.create_like(spark, f"{db}.again", f"{db}.sensors")
    catalog.drop_table(spark, f"{db}.sensors")
    return spark.table(f"{db}.again").select(*fx.SILVER)


@query("table_properties")
def table_properties(spark, d):
    """One table per event type; properties set when it is made, set later from its rows, and
    unset, read back as rows."""
    events, path = fx.events(spark, d), work_path(spark, "by-type")
    _write_parts(events, path, ["event_type"])
    rows = [f for f in events.schema.fields if f.name != "event_type"]
    about = (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").cast("date").alias("newest"))
             .collect())        # one row for each table that is made
    db = _database(spark, "properties")
    for r in about:
        name = f"{db}.{catalog.as_name(r['event_type'])}"
        catalog.create_table(spark, name, T.StructType(rows), location=f"{path}/event_type={r['event_type']}",
                             properties={"quality": "silver", "draft": "true"})
        catalog.set_properties(spark, name, {"rows": r["n"], "newest": r["newest"], "quality": "gold"})
        catalog.unset_properties(spark, name, "draft")
    return catalog.table_properties(spark, catalog.tables(spark, db)).select("table_name", "key", "value")


def _write_parts(rows: DataFrame, path: str, parts: list[str]) -> None:
    rows.hint("rebalance", *[F.col(c) for c in parts]).write.partitionBy(*parts).parquet(path)


# --- A8, J17: the catalog as a source ------------------------------------------------

@query("owned_tables_catalog")
def owned_tables_catalog(spark, d):
    """The ownership report over the catalog's own table list. One database per region and one
    external table of orders per market segment there, owned by the segment; the report's user
    owns what its group does."""
    prefix = f"tidepool_{uuid.uuid4().hex[:12]}"
    c, geo = fx.table_of(spark, d, "customer"), fx.geography(spark, d)
    orders = (fx.table_of(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
              .join(geo, F.col("c_nationkey") == F.col("nationkey"))
              .select("o_orderkey", "o_orderdate", "regionkey", F.col("c_mktsegment").alias("segment")))
    path = work_path(spark, "by-segment")
    _write_parts(orders, path, ["regionkey", "segment"])
    written = spark.read.parquet(path)
    about = (written.groupBy("regionkey", "segment").agg(F.max("o_orderdate").alias("newest"))
             .join(geo.select("regionkey", "catalog_name").distinct(), "regionkey").collect())  # a row for each table
    databases = {r: _database(spark, catalog.as_name(r), prefix) for r in {a["catalog_name"] for a in about}}
    rows = T.StructType([orders.schema["o_orderkey"], orders.schema["o_orderdate"]])
    for a in about:
        catalog.create_table(spark, f"{databases[a['catalog_name']]}.{catalog.as_name(a['segment'])}", rows,
                             location=f"{path}/regionkey={a['regionkey']}/segment={a['segment']}",
                             properties={catalog.OWNER: a["segment"], catalog.ALTERED: a["newest"]})
    listed = catalog.information_tables(spark, databases.values())
    entities = access.entity_set(fx.membership(spark, d), fx.ENTITY)
    owned = access.owned_tables(listed, entities)
    return owned.select("table_catalog", F.expr(f"substring(table_schema, {len(prefix) + 2})").alias("table_schema"),
                        "table_name", "last_altered", "last_altered_by", "storage_sub_directory",
                        F.col("created").isNotNull().alias("has_created"))


@query("database_listing")
def database_listing(spark, d):
    """One database per region with a table of customers per nation; those of odd regions are dropped
    with their tables, the first is made anew, empty. What the catalog then lists, with row counts."""
    prefix = f"tidepool_{uuid.uuid4().hex[:12]}"
    path, c = work_path(spark, "by-nation"), fx.table_of(spark, d, "customer")
    _write_parts(c.withColumn("nation", F.col("c_nationkey")), path, ["nation"])
    nations = fx.geography(spark, d).orderBy("nationkey").collect()         # one row for each table
    names = {n["regionkey"]: catalog.as_name(n["catalog_name"]) for n in nations}
    databases = {k: _database(spark, name, prefix) for k, name in names.items()}
    for n in nations:
        catalog.create_table(spark, f"{databases[n['regionkey']]}.{catalog.as_name(n['schema_name'])}", c.schema,
                             location=f"{path}/nation={n['nationkey']}")
    for key, name in databases.items():
        if key % 2:
            catalog.drop_database(spark, name)
    first = databases[min(databases)]
    catalog.create_database(spark, first, work_path(spark, "db-again"), start_over=True)
    found = [t for name in catalog.databases(spark, f"{prefix}_*") for t in catalog.tables(spark, name)]
    for t in found:
        catalog.analyze(spark, t)
    return catalog.describe(spark, found).select(
        F.expr(f"substring(schema_name, {len(prefix) + 2})").alias("database_name"), "table_name",
        F.col("statistics.num_rows").alias("num_rows"))


# --- J6, J7, J11: deletes by key, purge, log -----------------------------------------------

def _logged(spark, d) -> str:
    name = f"{_database(spark, 'logged')}.sensors"
    soft_delete.create(spark, name, fx.clean(spark, d, keep_event_id=True), PARTS)
    return name


@query("delete_by_key")
def delete_by_key(spark, d):
    """Rows deleted by key from a catalog table: no data file changes, the view leaves them out."""
    name = _logged(spark, d)
    soft_delete.delete(spark, name, "event_id % 11 = 0")
    return spark.table(name).select(*fx.SILVER)


@query("purge_by_key")
def purge_by_key(spark, d):
    """Two deletes, then a purge of one location and of the rest; the rows that are in the files."""
    name = _logged(spark, d)
    soft_delete.delete(spark, name, "event_id % 11 = 0")
    soft_delete.delete(spark, name, fx.PARTITION_PRED)
    soft_delete.purge(spark, name, "SensorLocation = 'loc_1'")
    soft_delete.purge(spark, name)
    return spark.table(f"{name}_rows").select(*fx.SILVER)


@query("operation_log")
def operation_log(spark, d):
    """What was done to a table, and to how many rows, as Spark counted them."""
    name = _logged(spark, d)
    soft_delete.delete(spark, name, "event_id % 11 = 0")
    soft_delete.purge(spark, name, "SensorLocation = 'loc_1'")
    soft_delete.delete(spark, name, fx.DELETE_PRED)
    return soft_delete.history(spark, name).select("version", "operation", "num_rows")


# --- J1, J2: defaults kept by the table ---------------------------------------------------

POLICIES = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                         T.StructField("description", T.StringType()), T.StructField("insert_timestamp", T.TimestampType())])


@query("insert_sql_defaults")
def insert_sql_defaults(spark, d):
    """Plain ``INSERT`` statements with column lists into a table that keeps its defaults; the last
    after the description got one too. Ids run on over all inserts."""
    name = f"{_database(spark, 'defaults')}.policies"
    catalog.create_table(spark, name, POLICIES, {"name": "'noname'", "insert_timestamp": "current_timestamp()"})
    c = fx.table_of(spark, d, "customer")
    full, text = F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description")
    for i, cols in enumerate([[full, text], [text], [full], [full]]):
        if i == 3:
            catalog.set_default(spark, name, "description", "'none'")
        catalog.insert(spark, name, c.filter(F.col("c_custkey") % 4 == i).select("c_custkey", *cols),
                       identity="id", order_by=["c_custkey"])
    return spark.table(name).select("id", "name", "description", F.col("insert_timestamp").isNotNull().alias("has_time"))


# --- B9, K2, A11: streams -------------------------------------------------------------------

@query("stream_merge_sql")
def stream_merge_sql(spark, d):
    """As ``stream_merge_silver``, with catalog tables: a stream over the table that holds ``U`` is
    merged into the one seeded with ``T`` by SQL over a global view of each micro-batch."""
    db, n = _database(spark, "silver"), feed_files(spark, d)
    catalog.create_table_as(spark, f"{db}.silver", fx.target_rows(spark, d).select(*fx.SILVER), PARTS)
    catalog.create_table_as(spark, f"{db}.bronze", fx.update_rows(spark, d).repartition(n))
    bronze = spark.readStream.option("maxFilesPerTrigger", str(n // 2)).table(f"{db}.bronze")
    merge_stream_sql(spark, bronze, f"{db}.silver", work_path(spark, "ckpt-sql"), query_name=f"{db}_merge")
    return spark.table(f"{db}.silver").select(*fx.SILVER)


@query("stream_interval")
def stream_interval(spark, d):
    """The feed drained by a long-running query on an interval trigger, a fourth of the files each
    time, stopped once the listener reports it idle."""
    feed, n = _feed(spark, d)
    bronze = _bronze(spark, "bronze-interval")
    name = f"interval_{uuid.uuid4().hex[:12]}"
    with Watch(spark, name, every="100 milliseconds") as seen:
        q = ingest_raw_to_bronze(spark, feed, bronze, work_path(spark, "ckpt-interval"), sensor_schema(T.TimestampNTZType()),
                                 max_files_per_trigger=n // 4, query_name=name, trigger=seen.trigger, await_done=False,
                                 timestamp_format=CSV_TIME_FORMAT)
        seen.stop_when_idle(q, triggers=2)
    return bronze.read().select(*BRONZE_OUT, _from_feed(feed))


@query("feed_inventory")
def feed_inventory(spark, d):
    """The feed's files as listed against the files its rows come from: rows read, whether each
    listed file was read and no other, and whether the sizes agree."""
    feed, _ = _feed(spark, d)
    listed = source_inventory(spark, feed, glob="*.csv").select(
        F.substring_index("path", "/", -1).alias("file"), "length")
    rows = read_sensor_csv(spark, feed, sensor_schema(T.TimestampNTZType()), CSV_TIME_FORMAT)
    read = (rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("size"))
            .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size")))
    return listed.join(read, "file", "full").agg(
        F.sum("rows").alias("num_rows"), F.every(is_true(F.col("length").isNotNull() & F.col("rows").isNotNull())).alias("same_files"),
        F.every(is_true(F.col("length") == F.col("size"))).alias("same_bytes"))
