"""Every registered query against its DuckDB oracle (sf0.001), plus the
entry point and plan properties."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF001
from tests.plans import plan_text
from tidepool.plans.oracle import ORACLE
from tidepool.plans.queries import REGISTRY
from tools.compare import digest, duck

QUERIES = REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_survey_key_registered():
    assert len(QUERIES) == 68 and set(QUERIES) <= set(entry_mod.queries())
    assert set(ORACLE) <= set(entry_mod.oracle_sql())
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"source_inventory"}


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 857
    assert df.columns[-1] == "Id"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    want = digest([c[0] for c in cur.description], cur.fetchall())
    assert got == want


def test_source_inventory_lists_every_table(spark):
    import os
    df = QUERIES["source_inventory"](spark, SF001)
    got = {r["file_name"]: r["size_bytes"] for r in df.collect()}
    want = {n: os.path.getsize(f"{SF001}/{n}") for n in os.listdir(SF001) if n.endswith(".parquet")}
    assert got == want


BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_plan_properties(spark, name):
    """All row work stays in the JVM (no Python UDF operator) and no query
    plans a cross join."""
    plan = plan_text(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pushdown_and_partition_pruning(spark, workdir):
    from pyspark.sql import functions as F
    from tidepool.functions.cleaning import clean_raw_data
    from tidepool.plans import fixtures as fx
    from tidepool.sources.table import ParquetTable
    t = ParquetTable.create_as(spark, workdir, fx.raw(spark, SF001, True),
                               ["SensorLocation", "SensorMeasurement"])
    cleaned = clean_raw_data(t.base())
    plan = plan_text(cleaned)
    assert "IsNotNull(SensorValue)" in plan               # filter reaches the scan
    assert "Skip" not in plan.split("ReadSchema:")[1].split("\n")[0]  # pruned columns
    part = t.base().filter((F.col("SensorMeasurement") == "view")
                           & (F.col("SensorLocation") == "loc_1"))
    filters = plan_text(part).split("PartitionFilters: [")[1].split("\n")[0]
    assert "(SensorMeasurement" in filters and "(SensorLocation" in filters


def test_merge_plans_anti_join(spark):
    plan = plan_text(QUERIES["merge_insert_only"](spark, SF001))
    assert "LeftAnti" in plan




@pytest.mark.parametrize("name", ["owned_tables", "stale_tables", "table_access", "catalog_access",
                                  "schema_access_inherited", "expand_privileges", "merge_insert_only",
                                  "merge_upsert", "change_feed", "incremental_by_max_ts"])
def test_planning_starts_no_job(spark, name):
    sc = spark.sparkContext
    group = f"planning-{name}"
    sc.setJobGroup(group, "building and explaining a query")
    try:
        plan_text(QUERIES[name](spark, SF001))
    finally:
        sc._jsc.clearJobGroup()
    # reading a Parquet footer for its schema is Spark's own one-task job
    jobs = [j for j in sc.statusTracker().getJobIdsForGroup(group)]
    stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert all(s is None or s.numTasks == 1 and s.name.startswith("parquet at") for s in stages)


@pytest.mark.parametrize("name", ["owned_tables", "stale_tables"])
def test_reports_broadcast_the_owners(spark, name):
    """With adaptive execution's real sizes, orders is joined where it lies."""
    df = QUERIES[name](spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_incremental_bound_reaches_the_scan(spark, workdir):
    from tidepool.operators.merge import incremental_by_max_ts
    spark.range(100).selectExpr("id", "timestamp_micros(id * 1000000) AS ts").write.parquet(workdir)
    source = spark.read.parquet(workdir)
    df = incremental_by_max_ts(source, source.filter("id < 90"), "ts")
    plan = plan_text(df)
    assert df.count() == 11
    assert plan.count("Subquery:") <= 2 and "DataFilters" not in plan.split("PushedFilters")[0]
