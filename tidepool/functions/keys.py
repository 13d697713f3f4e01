"""Row keys.

The default key is a content hash: replaying the same rows gives the same
keys, so an insert-only merge makes replays idempotent. A random key
(``uuid()``, JVM-side) is available when every arrival must count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How values are written inside a key. JSON quotes and names every value, so no
# two different rows share a text; times are written in UTC with microseconds, so the session's
# zone does not matter.
KEY_OPTIONS = {"ignoreNullFields": "false", "timeZone": "UTC",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def content_key(*cols: str | Column) -> Column:
    """md5 of the columns as one JSON object."""
    return F.md5(F.to_json(F.struct(*cols), KEY_OPTIONS))


def assign_id(df: DataFrame, key_columns: list[str] | None = None,
              column: str = "Id", mode: str = "content") -> DataFrame:
    """Replace ``column`` with a generated key.

    ``mode='content'`` hashes ``key_columns`` (default: every other column);
    ``mode='random'`` draws a UUID per row (a recompute changes it).
    """
    if mode == "random":
        return df.withColumn(column, F.expr("uuid()"))
    if mode != "content":
        raise ValueError(f"unknown key mode {mode!r}")
    return df.withColumn(column, content_key(*(key_columns or [c for c in df.columns if c != column])))
