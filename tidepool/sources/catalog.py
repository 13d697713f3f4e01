"""Tables and databases by name, in the catalogs that Spark itself resolves.

Everything here is Spark SQL over plain Parquet tables: names have one to three parts
(``table``, ``database.table``, ``catalog.database.table``) and Spark looks them up, so the
functions work with any catalog that the session is configured with. Rows never pass the
driver; what does are statements and descriptions, one for each table named.

A Parquet table keeps column defaults, properties and its location, but has no owner that SQL
can set: the owner, and the time of the last change, are table properties (``OWNER``, ``ALTERED``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import mutate

# The table properties this library sets.
OWNER, ALTERED, UPGRADED_TO = "table_owner", "last_altered", "upgraded_to"

#: What ``DESCRIBE TABLE EXTENDED … AS JSON`` tells, as far as it is used.
DESCRIPTION = """catalog_name string, schema_name string, table_name string, type string, provider string,
    location string, created_time timestamp, partition_columns array<string>, table_properties map<string,string>,
    statistics struct<num_rows: bigint, size_in_bytes: bigint>,
    columns array<struct<name: string, `default`: string>>"""


def quoted(name: str) -> str:
    """A dotted name with each part in back quotes."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def as_name(value: str) -> str:
    """A value of the data as a table or database name (Spark's catalog takes letters, digits and ``_``)."""
    return re.sub(r"\W+", "_", value.lower(), flags=re.ASCII)


def text(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(properties: Mapping[str, object]) -> str:
    return ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items())


# --- databases ---------------------------------------------------------------

def create_database(spark: SparkSession, name: str, location: str | None = None,
                    start_over: bool = False) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; ``start_over`` first drops it with all its tables."""
    if start_over:
        drop_database(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}" + (f" LOCATION {text(location)}" if location else ""))


def drop_database(spark: SparkSession, name: str) -> None:
    """``DROP DATABASE IF EXISTS … CASCADE``: files of managed tables go, those of external tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")


def databases(spark: SparkSession, like: str = "*") -> list[str]:
    return [r[0] for r in spark.sql(f"SHOW DATABASES LIKE {text(like)}").collect()]


def tables(spark: SparkSession, database: str, like: str = "*") -> list[str]:
    """Names ``database.table`` of the tables (no temporary views) in a database."""
    found = spark.sql(f"SHOW TABLES IN {quoted(database)} LIKE {text(like)}").filter("NOT isTemporary")
    return [f"{database}.{r['tableName']}" for r in found.collect()]


# --- tables ------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, schema: T.StructType, defaults: Mapping[str, str] | None = None,
                 partition_by: Iterable[str] = (), location: str | None = None,
                 properties: Mapping[str, object] | None = None) -> DataFrame:
    """``CREATE TABLE name (column type DEFAULT expression, …)``: the table itself keeps the defaults."""
    defaults = defaults or {}
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
                     for f in schema.fields)
    spark.sql(f"CREATE TABLE {quoted(name)} ({cols}) {_clauses(partition_by, location, properties)}")
    return spark.table(quoted(name))


def create_table_as(spark: SparkSession, name: str, rows: DataFrame, partition_by: Iterable[str] = (),
                    location: str | None = None, properties: Mapping[str, object] | None = None) -> DataFrame:
    """``CREATE TABLE name [PARTITIONED BY …] [LOCATION …] AS SELECT``. With a location the table is
    external: its files outlive ``DROP TABLE``. The folder must be empty (Spark checks)."""
    partition_by = list(partition_by)
    if partition_by:        # few large files per partition; adaptive execution splits a heavy one
        rows = rows.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    spark.sql(f"CREATE TABLE {quoted(name)} {_clauses(partition_by, location, properties)} AS SELECT * FROM {{rows}}", rows=rows)
    return spark.table(quoted(name))


def attach(spark: SparkSession, name: str, path: str, properties: Mapping[str, object] | None = None) -> DataFrame:
    """An external table over Parquet files that lie there already; no row is read or moved."""
    spark.sql(f"CREATE TABLE {quoted(name)} {_clauses((), path, properties)}")
    return spark.table(quoted(name))


def _clauses(partition_by: Iterable[str], location: str | None, properties: Mapping[str, object] | None) -> str:
    parts = ", ".join(f"`{c}`" for c in partition_by)
    return ("USING parquet" + (f" PARTITIONED BY ({parts})" if parts else "")
            + (f" LOCATION {text(location)}" if location else "")
            + (f" TBLPROPERTIES ({_properties(properties)})" if properties else ""))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def insert(spark: SparkSession, name: str, rows: DataFrame, identity: str | None = None,
           order_by: list[str | Column] | None = None) -> None:
    """``INSERT INTO name (columns of rows) SELECT``: columns that ``rows`` lacks take the table's own
    defaults, else NULL. ``identity``: that column is numbered on from the table's largest value,
    in ``order_by`` order (by columns of ``rows``, which need not be the table's)."""
    if identity:
        top = spark.table(quoted(name)).agg(F.max(identity)).first()[0]
        rows = mutate.assign_identity(rows, identity, order_by=order_by, current_max=top)
    cols = [c for c in rows.columns if c in spark.table(quoted(name)).columns]
    listed = ", ".join(f"`{c}`" for c in cols)
    spark.sql(f"INSERT INTO {quoted(name)} ({listed}) SELECT {listed} FROM {{rows}}", rows=rows)


def set_default(spark: SparkSession, name: str, column: str, expression: str | None) -> None:
    """``ALTER TABLE … ALTER COLUMN … SET/DROP DEFAULT``, for later inserts."""
    what = "DROP DEFAULT" if expression is None else f"SET DEFAULT {expression}"
    spark.sql(f"ALTER TABLE {quoted(name)} ALTER COLUMN `{column}` {what}")


def create_like(spark: SparkSession, name: str, source: str, owner: str | None = None) -> DataFrame:
    """``CREATE TABLE name LIKE source COPY LOCATION``: a second external table over the source's own
    files, with its columns and partitions; no row is copied. ``source`` must be external if its
    files are to outlive it."""
    d = describe(spark, [source]).select("location", "partition_columns").first()
    spark.sql(f"CREATE TABLE {quoted(name)} LIKE {quoted(source)} LOCATION {text(d['location'])}")
    if d["partition_columns"]:
        recover_partitions(spark, name)
    if owner:
        set_properties(spark, name, {OWNER: owner})
    return spark.table(quoted(name))


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Tell the catalog of partition folders that it does not know yet."""
    spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")


# --- properties and descriptions -----------------------------------------------

def set_properties(spark: SparkSession, name: str, properties: Mapping[str, object]) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ({_properties(properties)})")


def unset_properties(spark: SparkSession, name: str, *keys: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ({', '.join(text(k) for k in keys)})")


def analyze(spark: SparkSession, name: str) -> None:
    """Row count and size of a table, computed by Spark and kept in the catalog."""
    spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS")


def describe(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """One row per table, as the catalog describes it (columns of ``DESCRIPTION``)."""
    told = [(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(n)} AS JSON").first()[0],) for n in names]
    return (spark.createDataFrame(told, "told string")
            .select(F.from_json("told", DESCRIPTION).alias("d")).select("d.*"))


def table_properties(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Properties as rows: (schema_name, table_name, key, value)."""
    return describe(spark, names).select("schema_name", "table_name", F.explode("table_properties"))


def information_tables(spark: SparkSession, database_names: Iterable[str]) -> DataFrame:
    """The table list that the access reports read (columns of ``information_schema.tables``), from the
    catalog's own descriptions; the folder is the table's location below its database's folder."""
    names = [t for d in database_names for t in tables(spark, d)]
    p = F.col("table_properties")
    return describe(spark, names).select(
        F.col("catalog_name").alias("table_catalog"), F.col("schema_name").alias("table_schema"), "table_name",
        p[OWNER].alias("table_owner"), p[ALTERED].cast("timestamp_ntz").alias("last_altered"),
        p[OWNER].alias("last_altered_by"), F.col("created_time").alias("created"),
        F.regexp_extract("location", r"([^/]+/[^/]+)/?$", 1).alias("storage_sub_directory"))


# --- migration -----------------------------------------------------------------

def migrate(spark: SparkSession, source: str, target: str, location: str | None = None,
            mark: bool = True) -> DataFrame:
    """Copy a table to another catalog or database: CTAS between two qualified names, partitioned like
    the source, into the target's own storage or an explicit location. ``mark`` notes the new name
    at the source, in its ``upgraded_to`` property."""
    parts = describe(spark, [source]).select("partition_columns").first()[0] or []
    copy = create_table_as(spark, target, spark.table(quoted(source)), parts, location)
    if mark:
        set_properties(spark, source, {UPGRADED_TO: target})
    return copy

