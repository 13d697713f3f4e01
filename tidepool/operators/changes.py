"""Row change feed between two versions of a table, and row expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.predicates import older_than
from tidepool.operators.joins import split_null_keys
from tidepool.operators.mutate import delete_where

# Change types of a row change feed.
INSERT, DELETE = "insert", "delete"
UPDATE_PRE, UPDATE_POST = "update_preimage", "update_postimage"


def change_feed(before: DataFrame, after: DataFrame, key: str | list[str] = "Id",
                change_column: str = "_change_type") -> DataFrame:
    """Rows that differ between ``before`` and ``after``, tagged.

    Keys must be unique within each side (they are table keys): the query fails when it runs if
    one is not. Rows are counted by key on the way to the join, so a repeated key shrinks to one
    row per task and is reported instead of pairing up. One full outer join on the key, then every
    joined pair yields zero, one or two change rows in the same pass (no second scan). Rows with a
    NULL key never match and go straight to insert / delete, so they cannot pile up in one shuffle
    partition. Equality is NULL-safe over the whole row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = before.columns
    after = after.select(*cols)

    b_keyed, b_null = split_null_keys(before, keys)
    a_keyed, a_null = split_null_keys(after, keys)
    kn = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, kn)]

    def one_per_key(rows: DataFrame, name: str) -> DataFrame:
        repeated = F.raise_error(F.lit(f"duplicate keys on {keys}: change feed needs unique keys")).cast("boolean")
        counted = (rows.select(*renamed, F.struct(*cols).alias(name)).groupBy(*kn)
                   .agg(F.first(name).alias(name), F.count(F.lit(1)).alias("_n")))
        return counted.filter(F.when(F.col("_n") > 1, repeated).otherwise(F.lit(True))).drop("_n")

    j = one_per_key(b_keyed, "_b").join(one_per_key(a_keyed, "_a"), on=kn, how="full_outer")

    def tag(row: str, kind: str) -> Column:
        return F.struct(F.col(row).alias("r"), F.lit(kind).alias("t"))

    changes = (F.when(F.col("_b").isNull(), F.array(tag("_a", INSERT)))
                .when(F.col("_a").isNull(), F.array(tag("_b", DELETE)))
                .when(~F.col("_b").eqNullSafe(F.col("_a")),
                      F.array(tag("_b", UPDATE_PRE), tag("_a", UPDATE_POST))))
    out = (j.select(F.explode(changes).alias("c"))
            .select("c.r.*", F.col("c.t").alias(change_column)))
    return (out.unionByName(a_null.withColumn(change_column, F.lit(INSERT)))
               .unionByName(b_null.withColumn(change_column, F.lit(DELETE))))


def expire_rows(df: DataFrame, ts_column: str, as_of: str | dt.datetime | Column,
                days: int) -> DataFrame:
    """Rows kept by a scheduled ``DELETE WHERE ts <= as_of - days``."""
    return delete_where(df, older_than(ts_column, as_of, days))
