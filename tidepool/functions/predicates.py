"""Predicate helpers with SQL's three-valued logic made explicit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(pred: Column | str) -> Column:
    """TRUE only where ``pred`` is TRUE; NULL counts as not matching."""
    p = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(p, F.lit(False))


def as_column(pred: Column | str) -> Column:
    return F.expr(pred) if isinstance(pred, str) else pred


def ts_literal(value: str | dt.datetime) -> Column:
    """A zone-less timestamp literal (stays ``timestamp_ntz``)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def older_than(column: str, as_of: str | dt.datetime | Column,
               days: int) -> Column:
    """``column <= as_of - INTERVAL days DAYS`` (NULL times never match)."""
    anchor = as_of if isinstance(as_of, Column) else ts_literal(as_of)
    return F.col(column) <= anchor - F.make_dt_interval(F.lit(days))
