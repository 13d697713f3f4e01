"""Tables by name: databases, defaults, properties, locations, migration, SQL merges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF001
from tests.plans import plan_text
from tidepool.operators import soft_delete
from tidepool.operators.merge import one_per_key, rows_to_insert
from tidepool.plans import fixtures as fx
from tidepool.session import work_path
from tidepool.sources import catalog, files
from tidepool.streaming.sql_sink import GLOBAL, merge_statement, merge_stream_sql

PARTS = ["SensorLocation", "SensorMeasurement"]
POLICY = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("description", T.StringType()), T.StructField("at", T.TimestampType())])


@pytest.fixture
def db(spark, workdir):
    name = "tp_" + workdir.rsplit("-", 1)[-1]
    catalog.create_database(spark, name, workdir)
    yield name
    catalog.drop_database(spark, name)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_names_and_literals_are_quoted(spark, db):
    assert catalog.quoted("c.d.my table") == "`c`.`d`.`my table`"
    value = "it's a \\ 'quoted' value"
    assert spark.sql(f"SELECT {catalog.text(value)}").first()[0] == value
    assert catalog.as_name("My table, 2!") == "my_table_2_"
    name = f"{db}.{catalog.as_name('My table')}"
    catalog.create_table(spark, name, T.StructType([T.StructField("a b", T.IntegerType())]), properties={"it's": value})
    assert catalog.tables(spark, db) == [f"{db}.my_table"]
    assert bag(catalog.table_properties(spark, [name]).select("key", "value")) == [("it's", value)]
    catalog.insert(spark, name, spark.sql("SELECT 1 AS `a b`"))
    assert bag(spark.table(name)) == [(1,)]


def test_database_lifecycle(spark, db, workdir):
    kept = work_path(spark, "kept")
    catalog.create_table_as(spark, f"{db}.inside", spark.range(3))
    catalog.create_table_as(spark, f"{db}.outside", spark.range(4), location=kept)
    spark.range(1).createOrReplaceTempView("a_session_view")
    assert catalog.tables(spark, db) == [f"{db}.inside", f"{db}.outside"]
    spark.catalog.dropTempView("a_session_view")                   # other tests list this session's tables
    assert db in catalog.databases(spark, "tp_*")
    catalog.create_database(spark, db, workdir)                    # IF NOT EXISTS: nothing happens
    assert len(catalog.tables(spark, db)) == 2
    catalog.create_database(spark, db, workdir + "-again", start_over=True)
    assert catalog.tables(spark, db) == []
    assert not files.exists(spark, f"{workdir}/inside")            # managed: gone with the database
    assert spark.read.parquet(kept).count() == 4                   # external: stays
    catalog.drop_database(spark, db)
    catalog.drop_database(spark, db)                               # IF EXISTS
    assert db not in catalog.databases(spark)


def test_defaults_are_kept_by_the_table(spark, db):
    name = f"{db}.policies"
    catalog.create_table(spark, name, POLICY, {"name": "'noname'", "at": "current_timestamp()"})
    spark.sql(f"INSERT INTO {name} (id, description) VALUES (1, 'd')")                      # plain SQL uses them
    catalog.insert(spark, name, spark.sql("SELECT 2L AS id, CAST(NULL AS STRING) AS name"))   # explicit NULL stays
    catalog.set_default(spark, name, "description", "'none'")
    catalog.insert(spark, name, spark.sql("SELECT 'x' AS name"), identity="id")
    catalog.set_default(spark, name, "name", None)
    catalog.insert(spark, name, spark.sql("SELECT 7L AS id"))
    got = bag(spark.table(name).select("id", "name", "description", F.col("at").isNotNull()))
    assert got == [(1, "noname", "d", True), (2, None, None, True), (3, "x", "none", True), (7, None, "none", True)]
    told = {c["name"]: c["default"] for c in catalog.describe(spark, [name]).first()["columns"]}
    assert told == {"id": None, "name": None, "description": "'none'", "at": "current_timestamp()"}


def test_identity_continues_in_the_given_order(spark, db):
    name = f"{db}.numbered"
    catalog.create_table(spark, name, T.StructType(POLICY.fields[:2]))
    for part in (0, 1):
        rows = spark.range(40).filter(f"id % 2 = {part}").selectExpr("concat('n', id) AS name", "-id AS turn")
        catalog.insert(spark, name, rows.repartition(4), identity="id", order_by=["turn"])
    want = [f"n{i}" for part in (0, 1) for i in range(39, -1, -1) if i % 2 == part]
    assert [r["name"] for r in spark.table(name).orderBy("id").collect()] == want
    assert [r["id"] for r in spark.table(name).orderBy("id").collect()] == list(range(1, 41))


def test_insert_into_an_empty_frame_and_unknown_columns(spark, db):
    name = f"{db}.t"
    catalog.create_table(spark, name, POLICY, {"name": "'noname'"})
    catalog.insert(spark, name, spark.sql("SELECT 1L AS id, 'extra' AS other WHERE false"), identity="id")
    assert spark.table(name).count() == 0
    catalog.insert(spark, name, spark.sql("SELECT 'extra' AS other, 'd' AS description"), identity="id")
    assert bag(spark.table(name).select("id", "name", "description")) == [(1, "noname", "d")]


def test_location_outlives_the_name_and_must_be_empty(spark, db):
    path = work_path(spark, "at")
    rows = fx.clean(spark, SF001)
    catalog.create_table_as(spark, f"{db}.t", rows, PARTS, location=path)
    with pytest.raises(Exception, match="(?i)empty"):
        catalog.create_table_as(spark, f"{db}.t2", rows, PARTS, location=path)
    catalog.drop_table(spark, f"{db}.t")
    assert catalog.tables(spark, db) == []
    assert spark.read.parquet(path).count() == rows.count()
    again = catalog.attach(spark, f"{db}.t3", path)
    catalog.recover_partitions(spark, f"{db}.t3")
    assert again.count() == rows.count()


def test_create_like_shares_the_files(spark, db):
    source = f"{db}.s"
    catalog.create_table_as(spark, source, fx.clean(spark, SF001), PARTS, location=work_path(spark, "shared"))
    catalog.create_like(spark, f"{db}.l", source, owner="group-a")
    d = catalog.describe(spark, [source, f"{db}.l"]).orderBy("table_name").collect()
    assert d[0]["location"] == d[1]["location"] and d[0]["partition_columns"] == PARTS == d[1]["partition_columns"]
    assert d[0]["table_properties"][catalog.OWNER] == "group-a"
    before = spark.table(f"{db}.l").count()
    spark.sql(f"INSERT INTO {source} BY NAME SELECT * FROM {source} WHERE SensorLocation = 'loc_1'")
    spark.catalog.refreshTable(f"{db}.l")
    assert spark.table(f"{db}.l").count() == before + fx.clean(spark, SF001).filter("SensorLocation = 'loc_1'").count()


@pytest.mark.parametrize("located", [False, True])
def test_migrate(spark, db, located):
    source, target = f"spark_catalog.{db}.old", f"spark_catalog.{db}.new"
    catalog.create_table_as(spark, source, fx.clean(spark, SF001), PARTS)
    path = work_path(spark, "moved") if located else None
    copy = catalog.migrate(spark, source, target, path)
    assert bag(copy.select(*fx.SILVER)) == bag(spark.table(source).select(*fx.SILVER))
    d = {r["table_name"]: r for r in catalog.describe(spark, [source, target]).collect()}
    assert d["old"]["table_properties"] == {catalog.UPGRADED_TO: target} and not d["new"]["table_properties"]
    assert d["new"]["partition_columns"] == PARTS
    assert d["new"]["type"] == ("EXTERNAL" if located else "MANAGED")
    assert (d["new"]["location"].split(":", 1)[-1] == path.split(":", 1)[-1]) if located else "/new" in d["new"]["location"]
    spark.sql(f"DROP TABLE {source}")
    assert copy.count() == fx.clean(spark, SF001).count()
    with pytest.raises(Exception, match="(?i)not found|cannot be found"):
        catalog.migrate(spark, source, f"{db}.other")


def test_properties_set_and_unset(spark, db):
    name = f"{db}.t"
    catalog.create_table(spark, name, POLICY, properties={"a": 1, "b": "x"})
    catalog.set_properties(spark, name, {"b": "y", "c": dt.date(2024, 1, 2)})
    catalog.unset_properties(spark, name, "a", "never there")
    assert bag(catalog.table_properties(spark, [name])) == [(db, "t", "b", "y"), (db, "t", "c", "2024-01-02")]
    assert catalog.table_properties(spark, []).count() == 0


def test_information_tables(spark, db):
    catalog.create_table_as(spark, f"{db}.mine", spark.range(5), properties={
        catalog.OWNER: "me", catalog.ALTERED: "2024-01-02 03:04:05"})
    catalog.create_table_as(spark, f"{db}.nobodys", spark.range(2))
    catalog.analyze(spark, f"{db}.mine")
    rows = {r["table_name"]: r for r in catalog.information_tables(spark, [db]).collect()}
    assert rows["mine"]["table_owner"] == "me" and rows["mine"]["table_catalog"] == "spark_catalog"
    assert rows["mine"]["last_altered"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows["mine"]["storage_sub_directory"].endswith("/mine") and rows["mine"]["created"] is not None
    assert rows["nobodys"]["table_owner"] is None and rows["nobodys"]["last_altered"] is None
    counted = catalog.describe(spark, [f"{db}.mine", f"{db}.nobodys"]).select("table_name", "statistics.num_rows")
    assert bag(counted) == [("mine", 5), ("nobodys", None)]


# --- merge by SQL over a global view --------------------------------------------

SCHEMA = "Id string, v int, p string"


def merged(spark, db, batches, start=(), parts=("p",)):
    """Batches (lists of rows) through the stream, one file and one trigger each; the table's rows."""
    target, path = f"{db}.target", work_path(spark, "batches")
    catalog.create_table_as(spark, target, spark.createDataFrame(list(start), SCHEMA), parts)
    for b in batches:
        spark.createDataFrame(b, SCHEMA + ", extra int").coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(SCHEMA + ", extra int").option("maxFilesPerTrigger", "1").parquet(path)
    for checkpoint in ("a", "b"):       # the second one replays everything
        merge_stream_sql(spark, source, target, f"{path}-ckpt-{checkpoint}", query_name=f"{db}_{checkpoint}")
    return bag(spark.table(target).select("Id", "v", "p"))


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_sql_merge_inserts_absent_keys_once(spark, db, parts):
    got = merged(spark, db, [[("a", 9, "x", 1), ("b", 2, "x", 1), ("b", 1, "y", 1)], [("b", 5, "x", 1), ("c", 3, None, 1)]],
                 [("a", 1, "x")], parts)
    assert got == sorted([("a", 1, "x"), ("b", 1, "y"), ("c", 3, None)], key=repr)
    assert not [t for t in spark.catalog.listTables(GLOBAL) if t.name.startswith(db)]


def test_sql_merge_of_rows_without_a_key(spark, db):
    got = merged(spark, db, [[(None, 1, "x", 1), (None, 1, "x", 1), ("a", 1, "x", 1)]])
    # At least once: each of the two runs inserts them, as they cannot be recognised.
    assert got == sorted([(None, 1, "x")] * 4 + [("a", 1, "x")], key=repr)


def test_sql_merge_finds_partitions_the_catalog_does_not_know(spark, db):
    """Files of a write that died before the catalog was told: a replay must not add them again."""
    target = f"{db}.target"
    path = work_path(spark, "target")
    catalog.create_table_as(spark, target, spark.createDataFrame([("a", 1, "x")], SCHEMA), ["p"], location=path)
    spark.createDataFrame([("b", 1, "new")], SCHEMA).write.mode("append").partitionBy("p").parquet(path)
    source = work_path(spark, "source")
    spark.createDataFrame([("b", 1, "new"), ("c", 1, "new")], SCHEMA).write.parquet(source)
    merge_stream_sql(spark, spark.readStream.schema(SCHEMA).parquet(source), target, f"{source}-ckpt", query_name=f"{db}_m")
    assert bag(spark.table(target).select("Id", "v", "p")) == [("a", 1, "x"), ("b", 1, "new"), ("c", 1, "new")]


def test_sql_merge_equals_the_frame_operators(spark, db):
    t, u = (f(spark, SF001).select(*fx.SILVER) for f in (fx.target_rows, fx.update_rows))
    u = u.unionByName(u.filter("SensorLocation = 'loc_1'").withColumn("SensorValue", F.col("SensorValue").cast("decimal(10,0)")))
    catalog.create_table_as(spark, f"{db}.t", t, PARTS)
    u.createOrReplaceGlobalTempView(f"{db}_u")
    spark.sql(merge_statement(f"{db}.t", f"{GLOBAL}.{db}_u", spark.table(f"{db}.t").columns, ["Id"], PARTS))
    spark.catalog.dropGlobalTempView(f"{db}_u")
    want = t.unionByName(rows_to_insert(t, one_per_key(u), "Id"))
    assert bag(spark.table(f"{db}.t").select(*fx.SILVER)) == bag(want.select(*fx.SILVER))


def test_sql_merge_reads_only_keys_of_the_table(spark, db):
    catalog.create_table_as(spark, f"{db}.t", fx.target_rows(spark, SF001).select(*fx.SILVER), PARTS)
    fx.update_rows(spark, SF001).select(*fx.SILVER).createOrReplaceGlobalTempView(f"{db}_u")
    sql = merge_statement(f"{db}.t", f"{GLOBAL}.{db}_u", spark.table(f"{db}.t").columns, ["Id"], PARTS)
    select = sql[:sql.index("INSERT INTO")] + sql[sql.index(")\nSELECT") + 2:]
    plan = plan_text(spark.sql(select))
    spark.catalog.dropGlobalTempView(f"{db}_u")
    scans = [x for x in plan.split("\n\n") if "Scan parquet" in x and "Location: CatalogFileIndex" in x or "InMemoryFileIndex" in x and f"{db}" in x]
    assert "LeftSemi" in plan and "LeftAnti" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert any("ReadSchema: struct<Id:string>" in s for s in plan.split("\n\n")), scans


# --- deletes by key, purge, log ---------------------------------------------------

def logged(spark, db, rows, parts=("p",)):
    name = f"{db}.t"
    soft_delete.create(spark, name, spark.createDataFrame(rows, SCHEMA), list(parts))
    return name


def test_delete_hides_and_purge_removes(spark, db):
    rows = [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", None, "y"), (None, 5, None), ("e", 6, None), ("f", 7, "z")]
    name = logged(spark, db, rows)
    files_before = set(spark.table(f"{name}_rows").inputFiles())
    assert soft_delete.delete(spark, name, "v >= 5 OR Id = 'a'") == 4          # a NULL predicate keeps row d
    assert soft_delete.delete(spark, name, "v >= 5") == 0                      # deleted already
    left = [("b", 2, "x"), ("c", 3, "y"), ("d", None, "y")]
    assert bag(spark.table(name).select("Id", "v", "p")) == sorted(left, key=repr)
    assert set(spark.table(f"{name}_rows").inputFiles()) == files_before        # no data file changed
    assert soft_delete.purge(spark, name, "p = 'x'") == 1
    assert bag(spark.table(f"{name}_rows").select("Id", "v", "p")) == sorted(left + [(None, 5, None), ("e", 6, None), ("f", 7, "z")], key=repr)
    assert soft_delete.purge(spark, name) == 0                                 # nothing is left of two partitions
    assert soft_delete.purge(spark, name) == 0
    assert bag(spark.table(f"{name}_rows").select("Id", "v", "p")) == bag(spark.table(name).select("Id", "v", "p")) == sorted(left, key=repr)
    assert spark.table(f"{name}_deleted").count() == 0
    log = [tuple(r)[:3] for r in soft_delete.history(spark, name).collect()][::-1]
    assert log == [(0, soft_delete.CREATED, 7), (1, soft_delete.DELETED, 4), (2, soft_delete.DELETED, 0),
                   (3, soft_delete.PURGED, 1), (4, soft_delete.PURGED, 0), (5, soft_delete.PURGED, 0)]


def test_purge_leaves_the_session_as_it_was(spark, db):
    name = logged(spark, db, [("a", 1, "x"), ("b", 1, "x")])
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    soft_delete.delete(spark, name, "Id = 'a'")
    soft_delete.purge(spark, name)
    assert spark.conf.get(mode) == before and bag(spark.table(name).select("Id")) == [("b",)]


def test_rows_of_a_purged_key_can_come_back(spark, db):
    name = logged(spark, db, [("a", 1, "x"), ("b", 1, "x")])
    soft_delete.delete(spark, name, "Id = 'a'")
    catalog.insert(spark, f"{name}_rows", spark.createDataFrame([("a", 9, "x")], SCHEMA))
    assert bag(spark.table(name).select("Id", "v")) == [("b", 1)]               # hidden until purged
    soft_delete.purge(spark, name)
    catalog.insert(spark, f"{name}_rows", spark.createDataFrame([("a", 9, "x")], SCHEMA))
    assert bag(spark.table(name).select("Id", "v")) == [("a", 9), ("b", 1)]


def test_deleted_keys_are_pruned_with_their_partition(spark, db):
    name = logged(spark, db, [("a", 1, "x"), ("b", 1, "y")])
    soft_delete.delete(spark, name, "Id = 'a'")
    plan = plan_text(spark.table(name).filter("p = 'y'"))
    assert plan.count("PartitionFilters: [isnotnull(p") >= 1 and "LeftAnti" in plan
