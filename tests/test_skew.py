"""Hot keys: one key (or NULL) holding a third of the rows must neither
change results nor land in one task."""

from pyspark.sql import functions as F

from tidepool.operators import changes, merge, mutate

N = 3000


def _batch(spark):
    """A third NULL keys, a third one hot key, a third unique keys."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(None))
         .when(F.col("id") % 3 == 1, F.lit("hot"))
         .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("Id"),
        F.col("id").alias("v"))


def test_insert_only_with_hot_and_null_keys(spark):
    target = spark.range(N).select(
        F.when(F.col("id") % 3 == 1, F.lit("hot"))
         .otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("Id"),
        F.col("id").alias("v"))
    batch = _batch(spark)
    want = N // 3 + N // 3       # NULL keys insert, unique keys insert, hot key exists
    for limit in ("10MB", "-1"):  # broadcast, then shuffle
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            new = merge.rows_to_insert(target, batch)
            assert new.count() == want
            assert new.filter(F.col("Id") == "hot").count() == 0
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_change_feed_with_many_null_keys(spark):
    before = _batch(spark)
    after = _batch(spark).withColumn("v", F.when(F.col("Id") == "hot", F.col("v"))
                                     .otherwise(F.col("v") + 1))
    # NULL keys never match: every NULL row is a delete and an insert.
    out = changes.change_feed(before.filter(F.col("Id").isNull()),
                              after.filter(F.col("Id").isNull()))
    kinds = {r["_change_type"]: r["count"] for r in out.groupBy("_change_type").count().collect()}
    assert kinds == {"delete": N // 3, "insert": N // 3}
    uniq = changes.change_feed(before.filter(F.col("Id").startswith("k")),
                               after.filter(F.col("Id").startswith("k")))
    assert uniq.count() == 2 * (N // 3)


def test_identity_ties_spread_over_tasks(spark):
    df = spark.range(0, N, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = mutate.assign_identity(df, "seq", order_by=["k"]).collect()
    assert sorted(r["seq"] for r in out) == list(range(1, N + 1))
    ordered = sorted(out, key=lambda r: r["seq"])
    assert all(a["k"] <= b["k"] for a, b in zip(ordered, ordered[1:]))
    # the tie group (a third of the rows, k = 0) is split by the range
    # exchange (AQE would merge such tiny partitions, so not here)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = (df.orderBy("k", F.monotonically_increasing_id())
                   .select(F.spark_partition_id().alias("p"), "k")
                   .filter(F.col("k") == 0).groupBy("p").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1
