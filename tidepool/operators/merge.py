"""MERGE re-expressed as joins over frames.

Insert-only merge (``WHEN NOT MATCHED THEN INSERT *``) never touches
existing rows, so the write is a pure append of the anti-join result. The
upsert (update all on match, insert otherwise) is an anti-join of the
target against the source keys plus the source rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.cleaning import project_to_target
from tidepool.operators.joins import split_null_keys


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def rows_to_insert(target: DataFrame, updates: DataFrame,
                   key: str | list[str] = "Id",
                   target_columns: list[str] | None = None, once: bool = False) -> DataFrame:
    """Source rows whose key is absent from the target.

    * Only the key columns of the target are read (column pruning).
    * The target's keys are first semi-joined with the source's: a micro-batch is small, so
      Spark broadcasts its keys (by size) and the target is scanned where it lies. Keys found
      are de-duplicated map-side, so a hot key shrinks to one row per task.
    * Source rows with a NULL key never match: they skip the join.
    * Duplicates inside one batch all insert (MERGE semantics), or with ``once`` one row of each
      key (``one_per_key``). Target keys are looked up by the source's keys alone, so whole rows
      are brought together once, for the insert.
    """
    keys = _keys(key)
    cols = target_columns or target.columns
    keyed, null_keyed = split_null_keys(updates, keys)
    asked = keyed.select(*keys).distinct() if once else keyed.select(*keys)
    present = target.select(*keys).join(asked, on=keys, how="left_semi").distinct()
    if once:
        keyed = one_per_key(keyed, keys)
    new = keyed.join(present, on=keys, how="left_anti").unionByName(null_keyed)
    return project_to_target(new, cols)


def one_per_key(df: DataFrame, key: str | list[str] = "Id") -> DataFrame:
    """One row of each non-NULL key: the smallest in column order, so the choice does not
    depend on partitioning. Repeats shrink map-side."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    keyed, null_keyed = split_null_keys(df, keys)
    one = keyed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return one.select(*df.columns).unionByName(null_keyed)


def merge_insert_only(target: DataFrame, updates: DataFrame,
                      key: str | list[str] = "Id") -> DataFrame:
    """The target after an insert-only merge (existing rows unchanged)."""
    return target.unionByName(rows_to_insert(target, updates, key))


def check_unique_keys(updates: DataFrame, key: str | list[str] = "Id",
                      purpose: str = "upsert") -> int:
    """Raise if two source rows share a (non-NULL) key; else return the
    number of distinct non-NULL keys.

    A row-level upsert is ambiguous with duplicates. One distributed job: a
    per-key count (partial aggregation before the shuffle, so a hot key
    shrinks map-side), then a one-row summary.
    """
    keys = _keys(key)
    keyed, _ = split_null_keys(updates.select(*keys), keys)
    per_key = keyed.groupBy(*keys).count()
    row = per_key.agg(F.count(F.lit(1)).alias("keys"),
                      F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()
    if row["most"] > 1:
        raise ValueError(f"duplicate keys on {keys}: {purpose} needs unique keys")
    return int(row["keys"])


def merge_upsert(target: DataFrame, updates: DataFrame,
                 key: str | list[str] = "Id") -> DataFrame:
    """The target after ``UPDATE SET * / INSERT *`` keyed on ``key``.

    Target rows whose key appears in the source are replaced by the source row; the rest
    stay. Target rows with NULL keys never match and bypass the join. Two source rows with
    one key make the query fail when it runs: the count rides on the keys that are joined.
    """
    keys = _keys(key)
    src = project_to_target(updates, target.columns)
    src_keyed, _ = split_null_keys(src.select(*keys), keys)
    once = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate keys on {keys}: upsert needs unique keys")).cast("boolean"))
    src_keys = src_keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(once.otherwise(F.lit(True))).select(*keys)
    kept_keyed, kept_null = split_null_keys(target, keys)
    kept = (kept_keyed.join(src_keys, on=keys, how="left_anti").select(*target.columns)
            .unionByName(kept_null))
    return kept.unionByName(src)


def incremental_by_max_ts(updates: DataFrame, target: DataFrame,
                          ts_column: str = "MeasurementDateTime") -> DataFrame:
    """Source rows at or after the newest time already in the target.

    One comparison with a scalar subquery, so the bound can reach the scan. An empty target
    means the smallest time the type has: every row with a time passes. Rows without a time
    are never incremental and are left out."""
    bound = target.agg(F.coalesce(F.max(ts_column), _least(updates.schema[ts_column].dataType))).scalar()
    return updates.filter(F.col(ts_column) >= bound)


def _least(kind: T.DataType):
    """The smallest value of a time column's type."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("0001-01-01").cast(kind)
    return F.lit(float("-inf")).cast(kind) if isinstance(kind, T.FractionalType) else F.lit(-2**63)
