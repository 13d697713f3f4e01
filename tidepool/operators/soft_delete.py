"""Rows deleted by key, purged later, and a log of what was done: plain Spark tables and a view.

A logged table ``name`` is four names in Spark's catalog: ``name_rows`` (Parquet, partitioned), the keys
deleted from it in ``name_deleted`` (partitioned alike, so both are pruned together), the log
``name_history``, and the view ``name`` of the rows that are left. A delete is one pruned scan and one
small insert; no data file is touched. ``purge`` rewrites only partitions that hold deleted rows, by
Spark's dynamic partition overwrite, and forgets their keys.

A key names the same row for ever: a key that was deleted stays hidden, in whatever file, until ``purge``
has removed it. NULL keys are keys like others (compared NULL-safe). One writer per table is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.predicates import as_column, is_true
from tidepool.sources import catalog

# Operation names in the log.
CREATED, DELETED, PURGED = "CREATE TABLE AS SELECT", "DELETE", "REORG"
AT, BY = "deleted_at", "deleted_by"     # time, and version of the operation
LOG = T.StructType([T.StructField("version", T.LongType()), T.StructField("operation", T.StringType()),
                    T.StructField("num_rows", T.LongType()), T.StructField("at", T.TimestampType())])


def _names(name: str) -> tuple[str, str, str]:
    return f"{name}_rows", f"{name}_deleted", f"{name}_history"


def _same(a: str, b: str, columns: list[str]) -> str:
    return " AND ".join(f"{a}.`{c}` <=> {b}.`{c}`" for c in columns)


def _log(spark: SparkSession, name: str, operation: str, rows: int) -> None:
    history = catalog.quoted(_names(name)[2])
    spark.sql(f"INSERT INTO {history} SELECT (SELECT coalesce(max(version) + 1, 0) FROM {history}), "
              f"{catalog.text(operation)}, {rows}, current_timestamp()")


def create(spark: SparkSession, name: str, rows: DataFrame, partition_by: list[str],
           key: tuple[str, ...] = ("Id",)) -> DataFrame:
    """CTAS of a logged table; returns its view."""
    base, gone, history = _names(name)
    catalog.create_table_as(spark, base, rows, partition_by)
    marked = T.StructType([rows.schema[c] for c in dict.fromkeys((*key, *partition_by))] + [T.StructField(BY, T.LongType()), T.StructField(AT, T.TimestampType())])
    catalog.create_table(spark, gone, marked, {AT: "current_timestamp()"}, partition_by)
    catalog.create_table(spark, history, LOG)
    on = _same("r", "d", list(dict.fromkeys((*key, *partition_by))))
    spark.sql(f"CREATE VIEW {catalog.quoted(name)} AS SELECT r.* FROM {catalog.quoted(base)} r "
              f"LEFT ANTI JOIN {catalog.quoted(gone)} d ON {on}")
    _log(spark, name, CREATED, spark.table(catalog.quoted(base)).count())
    return spark.table(catalog.quoted(name))


def delete(spark: SparkSession, name: str, pred: Column | str) -> int:
    """``DELETE FROM name WHERE pred`` (a NULL predicate keeps the row); returns the rows deleted."""
    _, gone, log = _names(name)
    columns = [c for c in spark.table(catalog.quoted(gone)).columns if c not in (AT, BY)]
    version = spark.table(catalog.quoted(log)).agg(F.max("version") + 1).first()[0]
    hit = spark.table(catalog.quoted(name)).filter(is_true(as_column(pred))).select(*columns, F.lit(version).alias(BY))
    catalog.insert(spark, gone, hit)
    n = spark.table(catalog.quoted(gone)).filter(F.col(BY) == version).count()
    _log(spark, name, DELETED, n)
    return n


def _overwrite_partitions(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """``INSERT OVERWRITE`` of the partitions that ``rows`` have; they may be read from the same table."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(catalog.quoted(name))
    finally:
        spark.conf.unset(mode) if before is None else spark.conf.set(mode, before)


def purge(spark: SparkSession, name: str, where: Column | str | None = None) -> int:
    """``REORG TABLE name [WHERE partition-pred] APPLY (PURGE)``: rewrites the partitions that hold deleted rows;
    returns the rows written. One row per such partition reaches the driver, for the statements that drop it
    where nothing is left, and its keys."""
    base, gone, _ = _names(name)
    parts = list(catalog.describe(spark, [base]).first()["partition_columns"])
    marks = spark.table(catalog.quoted(gone))
    touched = (marks if where is None else marks.filter(is_true(as_column(where)))).select(*parts).distinct()
    left = spark.table(catalog.quoted(name))
    same = [F.col(f"t.{p}").eqNullSafe(F.col(f"v.{p}")) for p in parts]
    kept = left.alias("v").join(touched.alias("t"), same, "left_semi")
    still = {tuple(r[p] for p in parts): r["n"] for r in kept.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).collect()}
    all_ = [tuple(r) for r in touched.collect()]
    _overwrite_partitions(spark, base, kept.select(*spark.table(catalog.quoted(base)).columns)
                          .hint("rebalance", *[F.col(p) for p in parts]))
    for values in all_:
        spec = ", ".join(f"`{p}` = {'null' if v is None else catalog.text(v)}" for p, v in zip(parts, values))
        if values not in still:
            spark.sql(f"ALTER TABLE {catalog.quoted(base)} DROP IF EXISTS PARTITION ({spec})")
        spark.sql(f"ALTER TABLE {catalog.quoted(gone)} DROP IF EXISTS PARTITION ({spec})")
    n = sum(still.values())
    _log(spark, name, PURGED, n)
    return n


def history(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE HISTORY``: version, operation, rows written or deleted, time."""
    return spark.table(catalog.quoted(_names(name)[2])).orderBy(F.desc("version"))
