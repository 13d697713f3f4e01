"""Frames derived from the driver's tables (FIXTURES.md).

All are lazy DataFrames over the given tables, so their work grows with
the tables. ``sf_dir`` is the folder holding one Parquet file per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.cleaning import clean_raw_data
from tidepool.operators import access
from tidepool.sources.sensor import raw_rows, sensor_rows
from tidepool.sources.testdata import table

# Fixed values of the test scenarios (FIXTURES.md).
ENTITY = "Customer#000000000"
ACCESS_AS_OF = "1998-08-01 00:00:00"
STALE_DAYS = 30
EXPIRE_AS_OF = "2024-01-31 00:00:00"
EXPIRE_DAYS = 10
TARGET_BEFORE = "2024-01-15 00:00:00"
INSERT_AS_OF = "2024-02-01 00:00:00"
PARTITION_PRED = "SensorMeasurement = 'view' AND SensorLocation = 'loc_1'"
DELETE_PRED = "SensorValue > 20"

SILVER = ["Id", "MeasurementDateTime", "SensorValue", "SensorUnitDescription",
          "SensorMeasurement", "SensorLocation"]


def table_of(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def sensor(spark: SparkSession, d: str, keep_event_id: bool = False) -> DataFrame:
    return sensor_rows(events(spark, d), keep_event_id=keep_event_id)


def raw(spark: SparkSession, d: str, keep_event_id: bool = False) -> DataFrame:
    return raw_rows(events(spark, d), keep_event_id=keep_event_id)


def clean(spark: SparkSession, d: str, keep_event_id: bool = False) -> DataFrame:
    return clean_raw_data(sensor(spark, d, keep_event_id=keep_event_id))


def target_rows(spark: SparkSession, d: str) -> DataFrame:
    """``T``: the table before a merge (keeps ``event_id``). With ``U`` it covers every cleaned event."""
    return clean(spark, d, True).filter(F.col("event_id") % 3 != 1)


def update_rows(spark: SparkSession, d: str) -> DataFrame:
    """``U``: a batch of updates with shifted values (keeps ``event_id``)."""
    return (clean(spark, d, True).filter((F.col("event_id") % 2 == 0) | (F.col("event_id") % 3 == 1))
            .withColumn("SensorValue",
                        (F.col("SensorValue") + 1).cast(T.DecimalType(10, 0))))


# --- access-report fixtures ---------------------------------------------

def membership(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_name").alias("member"), F.col("c_mktsegment").alias("name"))


def geography(spark: SparkSession, d: str) -> DataFrame:
    """(nationkey, catalog_name, schema_name): catalog = region, schema = nation."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
             .select(F.col("n_nationkey").alias("nationkey"), F.col("r_regionkey").alias("regionkey"),
                     F.col("r_name").alias("catalog_name"), F.col("n_name").alias("schema_name")))


def schemas(spark: SparkSession, d: str) -> DataFrame:
    return geography(spark, d).select("catalog_name", "schema_name")


def _segment_regions(c: DataFrame, geo: DataFrame) -> DataFrame:
    """Segments granted a catalog: a customer of the segment lives in the region, and the region
    key and the segment name's length have equal parity."""
    return (c.join(geo, c["c_nationkey"] == geo["nationkey"])
             .filter((F.col("regionkey") + F.length("c_mktsegment")) % 2 == 0)
             .select(F.lit("admin").alias("grantor"), F.col("c_mktsegment").alias("grantee"), "catalog_name",
                     F.lit("USE_CATALOG").alias("privilege_type"), F.lit(access.EXPLICIT).alias("inherited_from"))
             .distinct())


def catalog_privileges(spark: SparkSession, d: str) -> DataFrame:
    return _segment_regions(table(spark, d, "customer"), geography(spark, d))


def schema_grants(spark: SparkSession, d: str, entities: DataFrame | None = None) -> DataFrame:
    """Explicit schema grants: every customer on its own nation (only the entities', if given)."""
    c = table(spark, d, "customer")
    if entities is not None:
        c = c.join(entities, c["c_name"] == entities["entity"], "left_semi")
    geo = geography(spark, d)
    return (c.join(geo, c["c_nationkey"] == geo["nationkey"])
             .select(F.lit("admin").alias("grantor"), F.col("c_name").alias("grantee"),
                     "catalog_name", "schema_name", F.lit("SELECT").alias("privilege_type")))


def schema_privileges(spark: SparkSession, d: str) -> DataFrame:
    return access.schema_privileges(schema_grants(spark, d),
                                    catalog_privileges(spark, d), schemas(spark, d))


def tables(spark: SparkSession, d: str, owners: DataFrame | None = None,
           nations: DataFrame | None = None) -> DataFrame:
    """One table per order, owned by the order's customer.

    ``owners(entity)`` narrows ``customer`` before the join with ``orders`` (the result is the
    same as filtering afterwards), so few customers remain and Spark broadcasts them.
    ``nations``: a frame like ``geography`` to use instead of it, so only tables in those
    schemas come out.
    """
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    geo = geography(spark, d) if nations is None else nations
    if owners is not None:
        c = c.join(owners, c["c_name"] == owners["entity"], "left_semi")
    c = c.join(geo, c["c_nationkey"] == geo["nationkey"])
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
             .select(F.col("catalog_name").alias("table_catalog"), F.col("schema_name").alias("table_schema"),
                     F.concat(F.lit("o_"), F.col("o_orderkey").cast("string")).alias("table_name"),
                     F.col("c_name").alias("table_owner"), F.col("o_orderdate").alias("last_altered"),
                     F.col("c_name").alias("last_altered_by"), F.col("o_orderdate").alias("created"),
                     F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("storage_sub_directory")))
