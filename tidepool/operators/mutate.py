"""Table mutation as frame operators: delete, selective overwrite, column
defaults, partial inserts and identity columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.predicates import as_column, is_true
from tidepool.session import ensure_checkpoint_dir

# Fixed value: bits of monotonically_increasing_id() that hold the row
# position inside its partition (the partition id sits above them).
_ROW_BITS = 33


def delete_where(df: DataFrame, pred: Column | str) -> DataFrame:
    """Rows kept by ``DELETE WHERE pred``: a NULL predicate keeps the row."""
    return df.filter(~is_true(as_column(pred)))


def replace_where(df: DataFrame, new_rows: DataFrame, pred: Column | str,
                  check: bool = True) -> DataFrame:
    """``INSERT INTO t REPLACE WHERE pred (new_rows)`` as a frame.

    Rows matching ``pred`` are replaced by ``new_rows``. Every new row must satisfy ``pred``: one
    that does not makes the query fail when it runs (checked in the same pass over the new rows).
    """
    p = as_column(pred)
    if check:
        stray = F.raise_error(F.lit("replace_where: some new rows do not satisfy the predicate")).cast("boolean")
        new_rows = new_rows.filter(F.when(is_true(p), F.lit(True)).otherwise(stray))
    return delete_where(df, p).unionByName(new_rows.select(*df.columns))


def apply_defaults(df: DataFrame, schema: T.StructType,
                   defaults: dict[str, Column | str] | None = None,
                   keep: list[str | Column] | None = None) -> DataFrame:
    """Shape ``df`` (the listed insert columns) to ``schema`` (and the columns named in ``keep``).

    Columns present in ``df`` keep their values, explicit NULLs included.
    Omitted columns take their default, else NULL. Everything is cast to
    the schema's type, and the schema's column order is used.
    """
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in defaults:
            d = defaults[f.name]
            c = F.expr(d) if isinstance(d, str) else d
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    known = {f.name for f in schema.fields}
    return df.select(*out, *[c for c in keep or [] if isinstance(c, str) and c not in known])


def insert_rows(target: DataFrame, batches: list[DataFrame], schema: T.StructType,
                defaults: dict[str, Column | str] | None = None) -> DataFrame:
    """The target after ``INSERT INTO t (cols) …`` for each batch."""
    out = target
    for b in batches:
        out = out.unionByName(apply_defaults(b, schema, defaults))
    return out


def assign_identity(df: DataFrame, column: str = "id",
                    order_by: list[str | Column] | None = None,
                    start: int = 1, step: int = 1,
                    current_max: int | None = None) -> DataFrame:
    """``GENERATED BY DEFAULT AS IDENTITY``: fill NULL ``column`` values.

    Explicit values win. Generated values are dense: ``start``, then every
    ``step`` (continuing after ``current_max`` when given), in ``order_by``
    order when given. No single-partition window: the rows to number are
    sorted by a range exchange and checkpointed (so the partitioning that is
    counted is the one that is numbered); each row's id is its position in
    its partition plus the number of rows in the partitions before it. The
    per-partition counts hold one row per partition, so their prefix sum
    and broadcast are bounded by the partition count, not the data.
    """
    if column not in df.columns:
        df = df.withColumn(column, F.lit(None).cast("long"))
    cols = df.columns
    explicit = df.filter(F.col(column).isNotNull())
    todo = df.filter(F.col(column).isNull())
    if order_by:
        # A unique tiebreaker lets the range exchange split a heavy group of
        # equal sort keys over many tasks (ties have no defined order).
        todo = todo.orderBy(*order_by, F.monotonically_increasing_id())
    ensure_checkpoint_dir(df.sparkSession)     # the session's shared folder
    todo = todo.checkpoint(eager=True)
    first = start if current_max is None else max(start, current_max + step)
    pos = (todo.withColumn("_pid", F.spark_partition_id())
               .withColumn("_row", F.monotonically_increasing_id()
                           .bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                  .select("_pid", "_off"))
    numbered = (pos.join(F.broadcast(offsets), "_pid")
                   .withColumn(column, (F.lit(first) + (F.col("_off") + F.col("_row"))
                                        * F.lit(step)).cast("long")))
    return explicit.unionByName(numbered.select(*cols))
