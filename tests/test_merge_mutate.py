"""Merge, delete, replace-where, defaults and identity as frame operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import changes, merge, mutate
from tests.plans import plan_text

S = "Id string, v int"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_insert_only_keeps_existing_and_null_keys(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], S)
    u = spark.createDataFrame([("a", 9), ("c", 3), ("c", 4), (None, 5)], S)
    out = merge.merge_insert_only(t, u)
    assert rows(out, "Id", "v") == sorted([("a", 1), ("b", 2), ("c", 3), ("c", 4), (None, 5)],
                                          key=str)


def test_upsert_replaces_matches(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 7)], S)
    u = spark.createDataFrame([("a", 9), ("c", 3)], S)
    out = merge.merge_upsert(t, u)
    assert rows(out, "Id", "v") == sorted([("a", 9), ("b", 2), ("c", 3), (None, 7)], key=str)


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([("a", 1)], S)
    u = spark.createDataFrame([("a", 2), ("a", 3)], S)
    with pytest.raises(Exception, match="duplicate keys"):
        merge.merge_upsert(t, u).collect()


def test_incremental_bound_and_empty_target(spark):
    u = spark.createDataFrame([(1,), (5,), (9,)], "ts int")
    t = spark.createDataFrame([(5,)], "ts int")
    assert rows(merge.incremental_by_max_ts(u, t, "ts"), "ts") == [(5,), (9,)]
    empty = spark.createDataFrame([], "ts int")
    assert merge.incremental_by_max_ts(u, empty, "ts").count() == 3


def test_delete_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([(1,), (30,), (None,)], "x int")
    assert rows(mutate.delete_where(df, "x > 20"), "x") == sorted([(1,), (None,)], key=str)


def test_replace_where_rejects_rows_outside(spark):
    df = spark.createDataFrame([("p", 1), ("q", 2)], "k string, v int")
    ok = spark.createDataFrame([("p", 5)], "k string, v int")
    assert rows(mutate.replace_where(df, ok, "k = 'p'"), "k", "v") == sorted([("p", 5), ("q", 2)], key=str)
    bad = spark.createDataFrame([("q", 5)], "k string, v int")
    with pytest.raises(Exception, match="do not satisfy the predicate"):
        mutate.replace_where(df, bad, "k = 'p'").collect()


def test_defaults_fill_omitted_only(spark):
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("description", T.StringType())])
    defaults = {"name": "'noname'"}
    a = spark.createDataFrame([("x",)], "description string")
    b = spark.createDataFrame([(None, "y")], "name string, description string")
    out = mutate.insert_rows(spark.createDataFrame([], schema), [a, b], schema, defaults)
    assert rows(out, "name", "description") == sorted([("noname", "x"), (None, "y")], key=str)


def test_defaults_match_sql_column_defaults(spark, workdir):
    """The frame form agrees with Spark SQL's DEFAULT columns on Parquet."""
    name = "tp_defaults_" + workdir.rsplit("-", 1)[-1]
    spark.sql(f"CREATE TABLE {name} (name STRING DEFAULT 'noname', description STRING) "
              f"USING parquet LOCATION '{workdir}'")
    spark.sql(f"INSERT INTO {name} (name, description) VALUES ('ada', 'SA')")
    spark.sql(f"INSERT INTO {name} (description) VALUES ('SA')")
    spark.sql(f"INSERT INTO {name} (name) VALUES ('ada')")
    sql_rows = rows(spark.table(name), "name", "description")
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("description", T.StringType())])
    batches = [spark.createDataFrame([("ada", "SA")], "name string, description string"),
               spark.createDataFrame([("SA",)], "description string"),
               spark.createDataFrame([("ada",)], "name string")]
    frame = mutate.insert_rows(spark.createDataFrame([], schema), batches, schema,
                               {"name": "'noname'"})
    assert rows(frame, "name", "description") == sql_rows


def test_identity_dense_unique_ordered_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=13).select((F.col("id") * 7 % 5000).alias("k"))
    out = mutate.assign_identity(df, column="seq", order_by=["k"]).collect()
    seq = sorted((r["k"], r["seq"]) for r in out)
    assert [s for _, s in seq] == list(range(1, 5001))


def test_identity_explicit_wins_and_continues(spark):
    df = spark.createDataFrame([(100, "a"), (None, "b"), (None, "c")], "id long, x string")
    out = mutate.assign_identity(df, "id", order_by=["x"], current_max=100)
    assert rows(out, "x", "id") == sorted([("a", 100), ("b", 101), ("c", 102)], key=str)


def test_change_feed_types_and_null_keys(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], S)
    after = spark.createDataFrame([("a", 1), ("b", 20), ("d", 5), (None, 6)], S)
    out = rows(changes.change_feed(before, after), "Id", "v", "_change_type")
    assert out == sorted([("b", 2, "update_preimage"), ("b", 20, "update_postimage"),
                          ("c", 3, "delete"), ("d", 5, "insert"),
                          (None, 4, "delete"), (None, 6, "insert")], key=str)


def test_operators_keep_column_order(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "v int, Id string")
    u = spark.createDataFrame([(3, "a"), (4, "c")], "v int, Id string")
    assert merge.merge_upsert(t, u).columns == ["v", "Id"]
    assert merge.merge_insert_only(t, u).columns == ["v", "Id"]
    assert changes.change_feed(t, u).columns == ["v", "Id", "_change_type"]


def test_change_feed_reports_repeated_keys(spark):
    ok = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], S)
    assert changes.change_feed(ok, ok).count() == 4   # NULL keys never match
    dup = spark.createDataFrame([("a", 1), ("a", 2)], S)
    for before, after in ((ok, dup), (dup, ok)):
        with pytest.raises(Exception, match="duplicate keys"):
            changes.change_feed(before, after).collect()


def test_replace_where_starts_no_job(spark):
    sc = spark.sparkContext
    df = spark.range(5).selectExpr("'p' AS k", "int(id) AS v")
    sc.setJobGroup("replace-where", "planning only")
    try:
        mutate.replace_where(df, df, "k = 'p'")
    finally:
        sc._jsc.clearJobGroup()
    assert not sc.statusTracker().getJobIdsForGroup("replace-where")


def test_insert_only_merge_of_repeated_keys_brings_whole_rows_together_once(spark):
    t = spark.createDataFrame([("a", 1, "t"), ("b", 1, "t")], "Id string, v int, w string")
    u = spark.createDataFrame([("a", 5, "u"), ("c", 3, "y"), ("c", 3, "x"), ("c", 4, "a"), ("d", None, None),
                               (None, 7, "n"), (None, 7, "n")], "Id string, v int, w string")
    new = merge.rows_to_insert(t, u, once=True)
    assert plan_text(new, "simple").count("min(struct(") == 2  # partial and final, of the rows to insert only
    cols = ("Id", "v", "w")
    assert rows(new, *cols) == rows(merge.rows_to_insert(t, merge.one_per_key(u)), *cols)
    assert rows(new, *cols) == [("c", 3, "x"), ("d", None, None), (None, 7, "n"), (None, 7, "n")]
