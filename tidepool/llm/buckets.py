"""Hashed n-grams: buckets, corpus tallies, and log-likelihood gains between two multinomials.

All of it is DataFrame functions. A gain is a whole number of thousandths of a nat, so sums do
not depend on the order of rows or partitions. Array elements are reached by ``zip_with`` over
shifted arrays: ``slice`` inside a lambda would copy the whole array at every element.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 1000  # gains are floored thousandths
PAIR = 31     # the bucket of a run of words is that of all but its last times PAIR plus the last's


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.transform(F.array(value), lambda x: use(x))[0]  # one argument: transform would add an index


def with_later(a: Column, b: Column, later: int, f: Callable[[Column, Column], Column]) -> Column:
    """f(a[i], b[i + later]) for every i that has both; ``b`` has ``later`` elements or more than that."""
    rest = F.slice(b, later + 1, F.size(b) - later)
    return F.zip_with(F.slice(a, 1, F.size(b) - later), rest, lambda x, y: f(x, y))


def bucket(word: Column, n: int) -> Column:
    """Unsigned crc32 of the UTF-8 bytes, modulo ``n``."""
    return (F.crc32(word.cast("binary")) % n).cast("int")


def runs(buckets: Column, orders: int, n: int) -> Column:
    """Buckets of all runs of 1 to ``orders`` consecutive words, from the words' buckets; repeats counted."""
    def of(b: Column, order: int) -> Column:
        if order == 1:
            return b
        longer = with_later(of(b, order - 1), b, order - 1, lambda x, y: (x * PAIR + y) % n)
        return F.when(F.size(b) >= order, longer).otherwise(F.array().cast("array<int>"))
    return buckets if orders == 1 else let(buckets, lambda b: F.concat(*[of(b, k) for k in range(1, orders + 1)]))


def tallies(found: DataFrame, codes: Column, **counted: Column) -> DataFrame:
    """(bucket, a sum over features of each named number). Sums are made before the shuffle: one row a
    bucket and task."""
    each = found.select(*[c.cast("long").alias(n) for n, c in counted.items()], F.explode(codes).alias("bucket"))
    return each.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in counted])


def gains(spark: SparkSession, counts: DataFrame, n: int) -> list[int]:
    """floor(1000 ln((t+1)(S+n) / ((s+1)(T+n)))) of each of the ``n`` buckets, for target counts ``t``
    and corpus counts ``s`` with totals T and S. ``n`` numbers reach the driver, as a model's weights do."""
    both = (spark.range(n).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    rows = both.agg(F.sum("s").cast("double").alias("S"), F.sum("t").cast("double").alias("T"),
                    F.sort_array(F.collect_list(F.struct("bucket", "s", "t"))).alias("rows"))   # n rows
    gain = lambda r: F.floor(SCALE * F.log(
        (r["t"] + 1).cast("double") * (F.col("S") + n) / ((r["s"] + 1).cast("double") * (F.col("T") + n)))).cast("int")
    return rows.select(F.transform("rows", gain).alias("gains")).first()["gains"]


def floored_mean(codes: Column, gain: list[int]) -> Column:
    """Mean gain of the features, rounded down (0 if there are none)."""
    table = F.from_json(F.lit(json.dumps(gain)), "array<int>")      # folded into one constant

    def mean(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0).cast("long"), lambda acc, b: acc + F.get(table, b))
        size = F.size(c).cast("long")
        return F.when(size > 0, F.floor((total - F.pmod(total, size)) / size)).otherwise(F.lit(0)).cast("long")
    return let(codes, mean)
