"""Join helpers shared by the operators.

Join strategies are left to Spark: it broadcasts a side from its statistics at plan time, or
from real sizes at run time (adaptive execution), and splits skewed partitions. Nothing here
counts rows while a query is planned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def any_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with some key NULL): rows with a NULL key never match an
    equi-join, so they bypass it instead of piling into one shuffle partition."""
    nulls = any_null(keys)
    return df.filter(~nulls), df.filter(nulls)
