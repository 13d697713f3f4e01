"""The cleaning transform of the raw feed and its building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.sources.sensor import SKIP_COLUMNS


def filter_not_null(df: DataFrame, column: str = "SensorValue") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def drop_columns(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Drop columns by name; names that are absent are ignored."""
    return df.drop(*(names if names is not None else SKIP_COLUMNS))


def clean_raw_data(df: DataFrame) -> DataFrame:
    """Keep rows with a value, drop the header-junk columns.

    Works unchanged on batch and streaming frames (``df.transform``).
    """
    return drop_columns(filter_not_null(df))


def project_to_target(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """By-name projection onto a target's columns (``INSERT *``).

    Extra source columns are ignored; a missing one is an error.
    """
    missing = [c for c in target_columns if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return df.select(*target_columns)
