"""Parquet table operations: traps T3/T4, soft delete, purge, snapshots,
clones, clustering, history."""

import pytest
from pyspark.sql import functions as F

from tidepool.plans import fixtures as fx
from tidepool.sources import files, table
from tidepool.sources.table import ParquetTable
from tests.conftest import SF001
from tests.plans import plan_text

PARTS = ["SensorLocation", "SensorMeasurement"]


@pytest.fixture
def clean_table(spark, workdir):
    return ParquetTable.create_as(spark, workdir, fx.clean(spark, SF001, True), PARTS)


def n_clean(spark):
    return fx.clean(spark, SF001).count()


def data_files(t):
    return {r["file"] for r in t.files().collect()}


def ids(df):
    return sorted(r["Id"] for r in df.collect())


def test_delete_leaves_every_data_file(spark, clean_table):
    before = data_files(clean_table)
    n = clean_table.delete("event_id % 11 = 0")
    assert n > 0
    assert clean_table.read().count() == n_clean(spark) - n
    assert data_files(clean_table) == before
    assert clean_table.base().count() == n_clean(spark)


def test_purge_keeps_visible_rows_and_drops_marked_files(spark, clean_table):
    clean_table.delete("event_id % 11 = 0")
    before = ids(clean_table.read())
    clean_table.purge("SensorLocation = 'loc_1'")
    assert ids(clean_table.read()) == before
    tombs = clean_table.tombstones()
    assert tombs.filter(F.col("_file").contains("SensorLocation=loc_1")).count() == 0
    assert tombs.count() > 0
    assert clean_table.base().filter("SensorLocation = 'loc_1' AND event_id % 11 = 0").count() == 0
    clean_table.purge()
    assert clean_table.tombstones().count() == 0 and ids(clean_table.read()) == before


def test_snapshot_survives_everything_while_live(spark, clean_table):
    snap = clean_table.snapshot()
    clean_table.delete("event_id % 11 = 0")
    clean_table.append(fx.clean(spark, SF001, True).limit(5))
    clean_table.purge()
    clean_table.cluster_by("MeasurementDateTime")
    assert ids(snap.read()) == ids(fx.clean(spark, SF001))
    assert clean_table.vacuum() is False
    kept = clean_table.read().count()
    snap.release()
    assert clean_table.vacuum() is True
    assert clean_table.read().count() == kept
    with pytest.raises(Exception):
        assert snap.read().count() == n_clean(spark)


def test_emptied_partition_disappears(spark, clean_table):
    """T4: a partition whose rows are all deleted has no file left after purge."""
    pred = "SensorLocation = 'loc_2' AND SensorMeasurement = 'view'"
    gone = clean_table.delete(pred)
    assert gone > 0
    assert clean_table.read().filter(pred).count() == 0
    clean_table.purge()
    assert clean_table.base().filter(pred).count() == 0
    assert not [f for f in data_files(clean_table) if "loc_2/SensorMeasurement=view" in f]


def test_reinserted_rows_are_visible(spark, workdir):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(10)], "Id string, v int")
    t = ParquetTable.create_as(spark, workdir, df)
    t.delete("Id = 'k3'")
    assert t.merge_insert_only(df.filter("Id = 'k3'")) == 1
    assert t.read().count() == 10
    t.delete("Id = 'k4'")
    t.append(df.filter("Id = 'k4'"))
    assert t.read().count() == 10


def test_delete_of_repeated_and_null_keys_hits_only_matching_rows(spark, workdir):
    rows = [("a", 100), ("a", 1), ("b", 100), ("b", 2), (None, 100), (None, 3)] + [(f"k{i}", i) for i in range(6)]
    t = ParquetTable.create_as(spark, workdir, spark.createDataFrame(rows, "Id string, v int"))
    assert t.delete("v = 100") == 3
    assert t.read().count() == 9 and t.read().filter("v = 100").count() == 0


def test_crash_before_the_rename_leaves_nothing(spark, clean_table, monkeypatch):
    before = ids(clean_table.read())

    def lost(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "rename", lost)
        for step in (lambda: clean_table.delete("event_id % 2 = 0"),
                     lambda: clean_table.append(fx.clean(spark, SF001, True))):
            with pytest.raises(OSError):
                step()
    assert ids(clean_table.read()) == before
    assert clean_table.delete("event_id % 11 = 0") + clean_table.read().count() == len(before)


def test_replace_where_is_one_operation(spark, clean_table):
    """T3: rows may be computed from the table that they replace."""
    pred = "SensorLocation = 'loc_1' AND SensorMeasurement = 'view'"
    new = clean_table.read().filter(pred).withColumn("SensorValue", (F.col("SensorValue") + 1).cast("decimal(10,0)"))
    want = sorted((r["Id"], r["SensorValue"]) for r in new.collect())
    version = clean_table.version()
    clean_table.replace_where(pred, new)
    got = sorted((r["Id"], r["SensorValue"]) for r in clean_table.read().filter(pred).collect())
    assert got == want and clean_table.version() == version + 1
    assert clean_table.read().filter(f"NOT ({pred})").count() == \
        fx.clean(spark, SF001).filter(f"NOT ({pred})").count()
    with pytest.raises(ValueError):
        clean_table.replace_where(pred, fx.clean(spark, SF001, True).filter(f"NOT ({pred})"))


def test_create_or_replace_from_itself(spark, clean_table):
    half = ids(clean_table.read().filter("event_id % 2 = 0"))
    t = ParquetTable.create_as(spark, clean_table.root, clean_table.read().filter("event_id % 2 = 0"), PARTS, replace=True)
    assert ids(t.read()) == half == ids(ParquetTable.open(spark, t.root).read())
    with pytest.raises(FileExistsError):
        ParquetTable.create_as(spark, t.root, t.read())


def test_upsert_on_table(spark, clean_table):
    u = fx.update_rows(spark, SF001)
    clean_table.upsert(u)
    got = {r["Id"]: r["SensorValue"] for r in clean_table.read().collect()}
    for r in u.collect():
        assert got[r["Id"]] == r["SensorValue"]
    assert len(got) == n_clean(spark)


def test_many_marks_are_not_broadcast(spark, clean_table, monkeypatch):
    """Marks are small as Parquet, so Spark would broadcast millions of them."""
    before = clean_table.read().filter("NOT coalesce(event_id % 3 = 0, false)").collect()
    assert 10 < clean_table.delete("event_id % 3 = 0") < table.BROADCAST_MARKS
    assert "BroadcastHashJoin" in plan_text(clean_table.read())
    monkeypatch.setattr(table, "BROADCAST_MARKS", 10)
    for rows in (clean_table.read(), clean_table._visible_located().select(*clean_table.schema.names)):
        assert "SortMergeJoin" in plan_text(rows) and "BroadcastHashJoin" not in plan_text(rows)
        assert sorted(map(str, rows.collect())) == sorted(map(str, before))


def test_deep_clone_independent(spark, clean_table, workdir):
    clone = clean_table.deep_clone(workdir + "-clone")
    clean_table.delete("event_id % 2 = 0")
    clean_table.purge()
    assert clone.read().count() == n_clean(spark)


def test_clone_of_clustered_files_is_written_without_a_shuffle(spark, clean_table, workdir):
    clean_table.cluster_by("MeasurementDateTime", num_ranges=16)
    sc = spark.sparkContext
    sc.setJobGroup("clone", "deep clone")
    try:
        clone = clean_table.deep_clone(workdir + "-clone")
    finally:
        sc._jsc.clearJobGroup()
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("clone")]
    assert jobs and all(len(j.stageIds) == 1 for j in jobs)
    assert ids(clone.read()) == ids(clean_table.read())


def test_cluster_by_time_disjoint_file_ranges(spark, clean_table):
    clean_table.cluster_by("MeasurementDateTime", num_ranges=16)
    ranges = (clean_table.base()
              .groupBy(*PARTS, F.col("_metadata.file_path").alias("f"))
              .agg(F.min("MeasurementDateTime").alias("lo"), F.max("MeasurementDateTime").alias("hi"))
              .collect())
    by_part = {}
    for r in ranges:
        by_part.setdefault((r[0], r[1]), []).append((r["lo"], r["hi"]))
    assert any(len(v) > 1 for v in by_part.values())
    for spans in by_part.values():
        spans.sort()
        for (lo1, hi1), (lo2, hi2) in zip(spans, spans[1:]):
            assert hi1 <= lo2
    assert clean_table.read().count() == n_clean(spark)


def test_heavy_time_is_clustered_by_several_tasks(spark):
    from tidepool.operators.layout import cluster_by_time
    df = spark.range(4000).select("id", F.lit("p").alias("p"), F.lit(1).alias("t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = cluster_by_time(df, ["p"], "t", 8).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 4


def test_history_newest_first(spark, clean_table):
    n = clean_table.delete("event_id % 11 = 0")
    clean_table.cluster_by("MeasurementDateTime")
    h = clean_table.history().collect()
    assert [r["operation"] for r in h] == ["OPTIMIZE", "DELETE", "CREATE TABLE AS SELECT"]
    assert [r["version"] for r in h] == [2, 1, 0]
    assert [(r["num_output_rows"], r["num_deleted_rows"]) for r in h] == [
        (n_clean(spark) - n, 0), (0, n), (n_clean(spark), 0)]


def test_detail_and_open(spark, clean_table):
    d = clean_table.detail()
    assert d["partitionColumns"] == PARTS and d["numFiles"] > 0 and d["sizeInBytes"] > 0
    parts = fx.clean(spark, SF001).select(*PARTS).distinct().count()
    assert d["numPartitions"] == parts and d["numTombstones"] == 0 and d["version"] == 0
    again = ParquetTable.open(spark, clean_table.root)
    assert again.partition_by == PARTS
    assert again.read().count() == n_clean(spark)
    n = clean_table.delete("event_id % 11 = 0")
    assert clean_table.detail()["numTombstones"] == n


def test_open_keeps_key_and_odd_partition_names(spark, workdir):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "pk string, `p,q` string, v int")
    ParquetTable.create_as(spark, workdir, df, ["p,q"], key=("pk",))
    t = ParquetTable.open(spark, workdir)
    assert t.key == ["pk"] and t.partition_by == ["p,q"]
    t.upsert(df.withColumn("v", F.col("v") + 10))
    assert sorted(r["v"] for r in t.read().collect()) == [11, 12]


def test_evolve_append(spark, workdir):
    old = fx.target_rows(spark, SF001).select(*fx.SILVER).drop("SensorUnitDescription")
    t = ParquetTable.create_as(spark, workdir, old)
    t.append(fx.update_rows(spark, SF001).select(*fx.SILVER), merge_schema=True)
    out = t.read()
    assert "SensorUnitDescription" in out.columns
    assert out.filter(F.col("SensorUnitDescription").isNull()).count() == old.count()
    assert ParquetTable.open(spark, workdir).schema.names == out.columns


def test_null_partition_values(spark, workdir):
    df = spark.createDataFrame(
        [("a", None, 1), ("b", None, 2), ("c", "x", 3), ("d", "x", 4)],
        "Id string, part string, v int")
    t = ParquetTable.create_as(spark, workdir, df, ["part"])
    assert t.delete("v = 4") == 1 and t.delete("v = 1") == 1 and t.delete("part IS NULL AND v = 7") == 0
    assert ids(t.read()) == ["b", "c"]
    t.delete("v = 2")
    t.purge("part IS NULL")
    assert ids(t.read()) == ["c"]
    assert t.tombstones().count() == 1 and t.base().filter(F.col("part").isNull()).count() == 0


def test_open_empty_partitioned_table(spark, workdir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("Id", T.StringType()), T.StructField("p", T.StringType()),
                           T.StructField("v", T.IntegerType())])
    ParquetTable.create(spark, workdir, schema, ["p"])
    t = ParquetTable.open(spark, workdir)
    assert t.schema == schema and t.partition_by == ["p"]
    assert t.read().count() == 0


def test_table_by_name(spark, clean_table):
    """Another session sees the visible rows by name, after every later operation."""
    other = spark.newSession()
    clean_table.register("tp_named")
    count = lambda: other.sql("SELECT COUNT(0) AS n FROM tp_named").first()["n"]
    assert count() == n_clean(spark)
    n = clean_table.delete("event_id % 11 = 0")
    assert count() == n_clean(spark) - n
    t = ParquetTable.named(spark, "tp_named")
    t.append(fx.clean(spark, SF001, True).limit(3).withColumn("extra", F.lit(1)), merge_schema=True)
    t.purge("SensorLocation = 'loc_1'")
    assert count() == t.read().count() == n_clean(spark) - n + 3
    assert other.sql("SELECT COUNT(extra) AS n FROM tp_named").first()["n"] == 3
    t.cluster_by("MeasurementDateTime")
    assert count() == n_clean(spark) - n + 3
    t.unregister()
    assert not spark.catalog.tableExists("tp_named") and t.read().count() == n_clean(spark) - n + 3


def test_insert_with_defaults_and_identity(spark, workdir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("at", T.TimestampType())])
    t = ParquetTable.create(spark, workdir, schema, key=("id",))
    defaults = {"name": "'none'", "at": "current_timestamp()"}
    for rows in ([("x",), ("y",)], [(None,)]):
        t.insert(spark.createDataFrame(rows, "name string"), defaults, identity="id", order_by=["name"])
    t.insert(spark.range(2).select(F.lit(None).cast("long").alias("id")), defaults, identity="id")
    got = t.read().orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in got] == [(1, "x"), (2, "y"), (3, None), (4, "none"), (5, "none")]
    assert all(r["at"] for r in got) and len({r["at"] for r in got if r["id"] > 3}) == 1


def test_views_and_changes_since_snapshot(spark, clean_table):
    clean_table.as_view("tp_silver_view")
    n = spark.sql("SELECT COUNT(0) AS n FROM tp_silver_view").first()["n"]
    assert n == n_clean(spark)
    snap = clean_table.snapshot()
    clean_table.delete("event_id % 11 = 0")
    ch = clean_table.changes_since(snap)
    kinds = {r["_change_type"] for r in ch.select("_change_type").distinct().collect()}
    assert kinds == {"delete"}
    assert ch.count() == n - clean_table.read().count()
    clean_table.as_view("tp_silver_global", global_view=True)
    assert spark.sql("SELECT COUNT(0) AS n FROM global_temp.tp_silver_global").first()["n"] \
        == n - ch.count()


def test_key_implied_time_range_reaches_scan(spark, clean_table):
    from tests.plans import plan_text
    batch = fx.clean(spark, SF001, True).filter("MeasurementDateTime < '2024-01-02'")
    scope = clean_table._implied_scope(batch, ["SensorLocation", "SensorMeasurement",
                                               "MeasurementDateTime"])
    plan = plan_text(clean_table.read().filter(scope).select("Id"))
    assert "GreaterThanOrEqual(MeasurementDateTime" in plan
    assert "LessThanOrEqual(MeasurementDateTime" in plan
    assert "PartitionFilters: [" in plan


def test_merge_that_touches_many_partitions_is_bounded_by_ranges(spark, clean_table, monkeypatch):
    from tests.plans import plan_text
    from tidepool.sources import table
    batch = fx.clean(spark, SF001, True).withColumn("Id", F.concat("Id", F.lit("-new"))).filter("event_id % 50 = 0")
    implied = ["SensorLocation", "SensorMeasurement", "MeasurementDateTime"]
    n = clean_table.read().count()
    monkeypatch.setattr(table, "SCOPE_PARTITIONS", 3)
    plan = plan_text(clean_table.read().filter(clean_table._implied_scope(batch, implied)).select("Id"))
    filters = plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert "SensorLocation" in filters and ">=" in filters and " IN " not in filters
    assert clean_table.merge_insert_only(batch, key_implies_partition=True, key_implies=["MeasurementDateTime"]) == batch.count()
    assert clean_table.merge_insert_only(batch, key_implies_partition=True, key_implies=["MeasurementDateTime"]) == 0
    assert clean_table.read().count() == n + batch.count()


def test_cluster_selected_partitions(spark, clean_table):
    clean_table.delete("event_id % 11 = 0")
    before = ids(clean_table.read())
    untouched = {f for f in data_files(clean_table) if "SensorLocation=loc_1" not in f}
    clean_table.cluster_by("MeasurementDateTime", num_ranges=8, where="SensorLocation = 'loc_1'")
    assert ids(clean_table.read()) == before
    assert untouched == {f for f in data_files(clean_table) if "SensorLocation=loc_1" not in f}
    left = clean_table.tombstones()
    assert left.count() > 0 and left.filter(F.col("_file").contains("SensorLocation=loc_1")).count() == 0


def test_changes_since_compares_only_touched_rows(spark, clean_table):
    from tidepool.operators.changes import change_feed
    snap = clean_table.snapshot()
    assert clean_table.changes_since(snap).count() == 0
    extra = (fx.clean(spark, SF001, True).filter("SensorLocation = 'loc_0'").limit(7)
             .withColumn("Id", F.concat(F.lit("new-"), F.col("Id"))))
    clean_table.append(extra)
    clean_table.delete("SensorLocation = 'loc_2' AND event_id % 5 = 0")
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    full = key(change_feed(snap.read(), clean_table.read(), "Id"))
    got = key(clean_table.changes_since(snap))
    assert got == full and len(got) > 7
    clean_table.purge()                                  # moves rows, changes none
    assert key(clean_table.changes_since(snap)) == full
    clean_table.cluster_by("MeasurementDateTime")        # full rewrite
    assert key(clean_table.changes_since(snap)) == full
    snap.release()


def test_stream_shows_visible_rows_only(spark, clean_table, workdir):
    from tidepool.streaming.pipeline import copy_stream
    clean_table.delete("event_id % 11 = 0")
    clean_table.purge("SensorLocation = 'loc_1'")
    copy = ParquetTable.create(spark, workdir + "-copy", clean_table.schema)
    other = ParquetTable.create_as(spark, workdir + "-src", clean_table.read(), PARTS)
    other.delete("event_id % 7 = 0")
    copy_stream(other, copy, workdir + "-ckpt")
    assert ids(copy.read()) == ids(other.read())
