"""Operators against brute-force Python models on random small inputs,
with NULL keys, repeated keys and NULL values."""

from collections import Counter

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tidepool.operators import changes, merge, mutate

KEYS = st.sampled_from([None, "a", "b", "c", "d", "e"])
VALS = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEYS, VALS), max_size=12)
SCHEMA = "Id string, v int"
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def unique_keys(rows):
    seen, out = set(), []
    for k, v in rows:
        if k is None or k not in seen:
            out.append((k, v))
            if k is not None:
                seen.add(k)
    return out


@SETTINGS
@given(target=ROWS, updates=ROWS)
def test_insert_only_model(spark, target, updates):
    t = spark.createDataFrame(target, SCHEMA)
    u = spark.createDataFrame(updates, SCHEMA)
    got = bag(merge.merge_insert_only(t, u))
    present = {k for k, _ in target if k is not None}
    want = Counter(target) + Counter(r for r in updates if r[0] is None or r[0] not in present)
    assert got == want


@SETTINGS
@given(target=ROWS, updates=ROWS)
def test_upsert_model(spark, target, updates):
    updates = unique_keys(updates)
    got = bag(merge.merge_upsert(spark.createDataFrame(target, SCHEMA),
                                 spark.createDataFrame(updates, SCHEMA)))
    keys = {k for k, _ in updates if k is not None}
    want = Counter(r for r in target if r[0] is None or r[0] not in keys) + Counter(updates)
    assert got == want


@SETTINGS
@given(rows=ROWS, bound=st.integers(0, 5))
def test_delete_model(spark, rows, bound):
    got = bag(mutate.delete_where(spark.createDataFrame(rows, SCHEMA), f"v > {bound}"))
    assert got == Counter(r for r in rows if not (r[1] is not None and r[1] > bound))


@SETTINGS
@given(before=ROWS, after=ROWS)
def test_change_feed_model(spark, before, after):
    before, after = unique_keys(before), unique_keys(after)
    got = bag(changes.change_feed(spark.createDataFrame(before, SCHEMA),
                                  spark.createDataFrame(after, SCHEMA)))
    b = {k: v for k, v in before if k is not None}
    a = {k: v for k, v in after if k is not None}
    want = Counter()
    want.update((k, v, "insert") for k, v in after if k is None or k not in b)
    want.update((k, v, "delete") for k, v in before if k is None or k not in a)
    for k in b.keys() & a.keys():
        if b[k] != a[k]:
            want.update([(k, b[k], "update_preimage"), (k, a[k], "update_postimage")])
    assert got == want


@SETTINGS
@given(keys=st.lists(st.integers(0, 4), max_size=30), parts=st.integers(1, 5))
def test_identity_model(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(parts)
    out = sorted((r["seq"], r["k"]) for r in mutate.assign_identity(df, "seq", ["k"]).collect())
    assert [s for s, _ in out] == list(range(1, len(keys) + 1))
    assert [k for _, k in out] == sorted(keys)


TABLE_ROWS = st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), VALS), min_size=1, max_size=10)
TABLE_SETTINGS = settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
                          suppress_health_check=[HealthCheck.function_scoped_fixture])


@TABLE_SETTINGS
@given(rows=TABLE_ROWS, new=TABLE_ROWS, bound=st.integers(0, 5))
def test_table_ops_equal_frame_ops(spark, rows, new, bound):
    from tidepool.session import work_path
    from tidepool.sources.table import ParquetTable
    schema = "Id string, p string, v int"
    data = [(f"k{i}", p, v) for i, (p, v) in enumerate(rows)]
    frame = spark.createDataFrame(data, schema)
    t = ParquetTable.create_as(spark, work_path(spark, "prop"), frame, ["p"])
    pred = f"v > {bound}"

    def check(want):
        assert bag(t.read()) == bag(want)

    t.delete(pred)
    want = mutate.delete_where(frame, pred)
    check(want)
    t.delete("v IS NULL")
    want = mutate.delete_where(want, "v IS NULL")
    check(want)
    repl = spark.createDataFrame([(f"n{i}", "x", v) for i, (_, v) in enumerate(new)], schema)
    t.replace_where("p = 'x'", repl)
    want = mutate.replace_where(want, repl, "p = 'x'")
    check(want)
    ups = spark.createDataFrame([(f"k{i}", p, 9) for i, (p, _) in enumerate(new)], schema)
    t.upsert(ups)
    want = merge.merge_upsert(want, ups, "Id")
    check(want)
    t.delete("v = 9")
    want = mutate.delete_where(want, "v = 9")
    check(want)
    t.purge("p = 'y'")
    check(want)
    t.purge()
    check(want)


@TABLE_SETTINGS
@given(target=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(0, 9))),
                       max_size=12),
       batch=st.lists(st.tuples(st.sampled_from(["x", "y", "z"]),
                                st.one_of(st.none(), st.integers(0, 9))), max_size=12))
def test_key_implied_scope_keeps_merge_result(spark, target, batch):
    """Narrowing the target by key-implied columns never changes the merge."""
    import datetime as dt
    from pyspark.sql import functions as F
    from tidepool.functions.keys import content_key
    from tidepool.session import work_path
    from tidepool.sources.table import ParquetTable

    def frame(rows):
        base = dt.datetime(2024, 1, 1)
        data = [(p, None if h is None else base + dt.timedelta(hours=h)) for p, h in rows]
        df = spark.createDataFrame(data, "p string, t timestamp_ntz")
        return df.withColumn("Id", content_key("p", "t")).select("Id", "p", "t")

    t = ParquetTable.create_as(spark, work_path(spark, "implied"), frame(target), ["p"])
    b = frame(batch)
    want = bag(merge.merge_insert_only(t.read(), b))
    t.merge_insert_only(b, key_implies_partition=True, key_implies=["t"])
    assert bag(t.read()) == want
    assert t.read().filter(F.col("Id").isNull()).count() == 0
