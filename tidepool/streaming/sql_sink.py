"""A micro-batch merged into a catalog table by SQL, in the batch's own session.

Each batch is published as a global temporary view, and one ``INSERT`` over that view and the
table does the insert-only merge (``MERGE … WHEN NOT MATCHED THEN INSERT *``, which Parquet tables
do not take). A batch that is replayed after a failure finds its keys in the table and adds
nothing; rows without a key cannot be recognised, and are inserted at least once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepool.sources import catalog
from tidepool.streaming.pipeline import run_stream

GLOBAL = "global_temp"


def merge_statement(target: str, view: str, columns: list[str], key: list[str], partition_by: list[str]) -> str:
    """``INSERT INTO target``: the view's rows with keys that the table lacks, one per key.

    The table's key column is first semi-joined with the batch's keys, so Spark can broadcast a
    small batch and scan the table where it lies, and a key found often shrinks map-side. Repeats
    in the batch shrink to the smallest row in column order, whatever the partitioning."""
    rest = [c for c in columns if c not in key]
    names = lambda cols, of="": ", ".join(f"{of}`{c}`" for c in cols)
    same = lambda a, b: " AND ".join(f"{a}.`{k}` = {b}.`{k}`" for k in key)
    has_key = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
    hint = f"/*+ REBALANCE({names(partition_by)}) */ " if partition_by else ""
    return f"""
WITH source AS (
    SELECT {names(key)}, least_row.*
    FROM (SELECT {names(key)}, min(struct({names(rest)})) AS least_row FROM {view} WHERE {has_key} GROUP BY {names(key)})),
known AS (SELECT DISTINCT {names(key, 't.')} FROM {target} t LEFT SEMI JOIN source s ON {same('t', 's')})
INSERT INTO {target} ({names(columns)})
SELECT {hint}{names(columns)} FROM (
    SELECT {names(columns, 's.')} FROM source s LEFT ANTI JOIN known k ON {same('s', 'k')}
    UNION ALL
    SELECT {names(columns)} FROM {view} WHERE NOT ({has_key}))"""


def merge_stream_sql(spark: SparkSession, rows: DataFrame, target: str, checkpoint: str,
                     key: tuple[str, ...] = ("Id",), query_name: str = "merge_sql",
                     trigger: dict | None = None, await_done: bool = True) -> StreamingQuery:
    """A stream merged insert-only into the catalog table ``target``, batch by batch.

    ``rows`` may have more columns than the table (``INSERT *`` takes the table's by name). The
    stream writes in a session of its own: another one that read the table before sees the new
    rows after ``REFRESH TABLE`` (done here for ``spark`` once an awaited stream has ended)."""
    told = catalog.describe(spark, [target]).select("partition_columns").first()
    parts = list(told["partition_columns"] or [])
    if parts:       # a write that died after its files appeared, before the catalog was told
        catalog.recover_partitions(spark, target)
    columns = spark.table(catalog.quoted(target)).columns
    view = f"{query_name}_updates"
    statement = merge_statement(catalog.quoted(target), f"{GLOBAL}.`{view}`", columns, list(key), parts)

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*[f"`{c}`" for c in columns]).persist()    # read by three branches; memory and disk
        try:
            batch.createOrReplaceGlobalTempView(view)
            batch.sparkSession.sql(statement)
        finally:
            batch.sparkSession.catalog.dropGlobalTempView(view)
            batch.unpersist()

    query = run_stream(rows, query_name, checkpoint, merge, trigger, await_done)
    if await_done:
        spark.catalog.refreshTable(catalog.quoted(target))
    return query
