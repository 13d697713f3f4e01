"""Statements the reference runs that Spark executes as they are (J16, J17),
and the interval trigger (K2)."""


from tidepool.plans import fixtures as fx
from tidepool.session import work_path
from tidepool.sources.table import ParquetTable
from tidepool.streaming.pipeline import copy_stream
from tests.conftest import SF001


def test_database_ddl_and_table_properties(spark, workdir):
    db = "tp_db_" + workdir.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(f"USE {db}")
    try:
        spark.sql(f"CREATE TABLE t (a INT) USING parquet LOCATION '{workdir}' "
                  "TBLPROPERTIES ('quality' = 'silver')")
        spark.sql("ALTER TABLE t SET TBLPROPERTIES ('upgraded_to' = 'x.y.z')")
        props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES t").collect()}
        assert props["quality"] == "silver" and props["upgraded_to"] == "x.y.z"
        assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]
        assert db in [r[0] for r in spark.sql("SHOW DATABASES").collect()]
    finally:
        spark.sql("USE default")
        spark.sql(f"DROP DATABASE {db} CASCADE")
    assert db not in [r[0] for r in spark.sql("SHOW DATABASES").collect()]


def test_processing_time_trigger(spark):
    src = ParquetTable.create_as(spark, work_path(spark, "src"),
                                 fx.clean(spark, SF001).select(*fx.SILVER))
    dst = ParquetTable.create(spark, work_path(spark, "dst"), src.schema)
    q = copy_stream(src, dst, work_path(spark, "ckpt"), trigger={"processingTime": "1 second"},
                    query_name="interval_copy", await_done=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert dst.read().count() == fx.clean(spark, SF001).count()
