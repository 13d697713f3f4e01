"""Parquet folders with table semantics: every operation adds one folder.

Layout under ``root``::

    g000001/                  a generation; the highest one marked ready is the table
        _table/               schema, partition columns, key, catalog name (rows, newest counts)
        _op=<seq>.<OP>.…/     the rows an operation added, partitioned by ``partition_by``
            _gone/            the rows it deleted: (file, row in the file)
            _dead/            the files it replaced whole: (file)
        _pins/<seq>-<id>/     live snapshots

An operation is written to a hidden folder and becomes visible by one rename, its
deletions with it; a crash before that leaves nothing. No data file is changed in place:
delete, replace-where and upsert mark rows by file and row number (whatever their keys,
NULLs or repeats, and without effect on later files) and append. ``purge`` and
``cluster_by`` rewrite; the files they replace are removed by ``vacuum``, and only while
no snapshot is live. CREATE OR REPLACE writes a new generation, marks it ready, and
deletes the old one last, so it may read the table it replaces.

The state is the list of operation folders: their names hold number, operation, row
counts and, for stream batches, stream and batch. One writer per table is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.predicates import as_column, is_true
from tidepool.operators import changes as change_ops
from tidepool.operators import merge as merge_ops
from tidepool.operators import mutate
from tidepool.operators.layout import cluster_by_time
from tidepool.sources import files

# Operation names shown in the history (DESCRIBE HISTORY).
OP_CREATE = "CREATE TABLE"
OP_CTAS = "CREATE TABLE AS SELECT"
OP_WRITE = "WRITE"
OP_STREAM = "STREAMING UPDATE"
OP_MERGE = "MERGE"
OP_DELETE = "DELETE"
OP_REORG = "REORG"
OP_OPTIMIZE = "OPTIMIZE"
OP_CLONE = "CLONE"

OP, FILE, ROW = "_op", "_file", "_row"
MAX_RECORDS_PER_FILE = 5_000_000
CLUSTER_BYTES = 256 << 20
BROADCAST_MARKS = 100_000   # marks of deleted rows that a task may hold whole (some 400 bytes each)
SCOPE_PARTITIONS = 1000     # table partitions that a merge names one by one; beyond, by their range
META_SCHEMA = "version long, schema string, partition_by array<string>, key array<string>, name string"


@dataclass(frozen=True)
class Op:
    """One operation, as its folder's name tells it."""
    seq: int
    operation: str
    rows: int
    gone: int
    dead: int
    full: bool          # the table starts anew here: earlier folders no longer count
    txn: str = ""

    @property
    def name(self) -> str:
        return ".".join([f"{self.seq:08d}", self.operation.replace(" ", "_"), str(self.rows),
                         str(self.gone), str(self.dead), "new" if self.full else "add", self.txn])

    @staticmethod
    def parse(name: str) -> Op:
        seq, operation, rows, gone, dead, full, txn = name.split(".", 6)
        return Op(int(seq), operation.replace("_", " "), int(rows), int(gone), int(dead),
                  full == "new", txn)


def _generations(spark: SparkSession, root: str) -> list[str]:
    return sorted(n for n in files.list_children(spark, root) if n.startswith("g"))


def _current(spark: SparkSession, root: str) -> str | None:
    ready = [g for g in _generations(spark, root) if files.exists(spark, f"{root}/{g}/_ready")]
    return ready[-1] if ready else None


class ParquetTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 partition_by: list[str] | tuple[str, ...] = (),
                 key: list[str] | tuple[str, ...] = ("Id",), generation: str = "g000001",
                 name: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by)
        self.key = list(key)
        self.generation = generation
        self.name = name

    # --- creation ---------------------------------------------------------

    @classmethod
    def _start(cls, spark, root, schema, partition_by, key, replace) -> tuple[ParquetTable, str | None]:
        root = root.rstrip("/")
        old = _current(spark, root)
        if old and not replace:
            raise FileExistsError(f"table exists at {root}")
        last = (_generations(spark, root) or ["g000000"])[-1]
        t = cls(spark, root, schema, partition_by, key, f"g{int(last[1:]) + 1:06d}")
        files.mkdirs(spark, t.data_path())
        t._write_meta(0)
        return t, old

    def _ready(self, old: str | None) -> ParquetTable:
        """Switch to this generation; only then remove the one it replaces."""
        files.mkdirs(self.spark, f"{self.data_path()}/_ready")
        if old:
            files.delete(self.spark, f"{self.root}/{old}")
        return self

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: T.StructType,
               partition_by=(), key=("Id",), replace: bool = False) -> ParquetTable:
        """``CREATE [OR REPLACE] TABLE root (schema) PARTITIONED BY (...)``."""
        t, old = cls._start(spark, root, schema, partition_by, key, replace)
        t._commit(OP_CREATE)
        return t._ready(old)

    @classmethod
    def create_as(cls, spark: SparkSession, root: str, df: DataFrame,
                  partition_by=(), key=("Id",), replace: bool = False,
                  operation: str = OP_CTAS, rebalance: bool = True) -> ParquetTable:
        """CTAS: the table holds exactly the rows of ``df``, which may read the replaced table.
        ``rebalance=False`` writes rows where they are, for a ``df`` laid out by partition already."""
        t, old = cls._start(spark, root, df.schema, partition_by, key, replace)
        t._commit(operation, df, rebalance=rebalance)
        return t._ready(old)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ParquetTable:
        """An existing table, as its newest description says."""
        root = root.rstrip("/")
        g = _current(spark, root)
        if g is None:
            raise FileNotFoundError(f"no table at {root}")
        m = (spark.read.schema(META_SCHEMA).parquet(f"{root}/{g}/_table")
             .orderBy(F.desc("version")).first())
        return cls(spark, root, T.StructType.fromJson(json.loads(m["schema"])),
                   m["partition_by"], m["key"], g, m["name"])

    @classmethod
    def named(cls, spark: SparkSession, name: str) -> ParquetTable:
        """The table registered in the catalog as ``name``."""
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return cls.open(spark, props["tidepool.root"])

    @staticmethod
    def exists(spark: SparkSession, root: str) -> bool:
        return _current(spark, root.rstrip("/")) is not None

    def _write_meta(self, version: int) -> None:
        row = [(version, self.schema.json(), self.partition_by, self.key, self.name)]
        (self.spark.createDataFrame(row, META_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.data_path()}/_table"))

    # --- state ------------------------------------------------------------

    def data_path(self) -> str:
        return f"{self.root}/{self.generation}"

    def _op_path(self, op: Op) -> str:
        return f"{self.data_path()}/{OP}={op.name}"

    def ops(self, as_of: int | None = None) -> list[Op]:
        """All operations in order, read from the folder names."""
        names = files.list_children(self.spark, self.data_path())
        found = sorted((Op.parse(n[len(OP) + 1:]) for n in names if n.startswith(f"{OP}=")),
                       key=lambda o: o.seq)
        return [o for o in found if as_of is None or o.seq <= as_of]

    def live_ops(self, as_of: int | None = None) -> list[Op]:
        """Operations whose folders count: from the last full rewrite on."""
        found = self.ops(as_of)
        start = max((i for i, o in enumerate(found) if o.full), default=0)
        return found[start:]

    def version(self) -> int:
        return self.ops()[-1].seq

    # --- reading ----------------------------------------------------------

    def _schema_with_op(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(OP, T.StringType())])

    def _rows(self, ops: list[Op]) -> DataFrame:
        """Rows of the operations' folders, deleted ones included, with ``_op``."""
        df = self.spark.read.schema(self._schema_with_op()).parquet(self.data_path())
        return df.filter(F.col(OP).between(ops[0].name, ops[-1].name)) if ops else df.limit(0)

    @staticmethod
    def _located(df: DataFrame) -> DataFrame:
        """Adds where a row lies: its file below the table folder, and its number there."""
        return df.withColumns({FILE: F.substring_index("_metadata.file_path", f"/{OP}=", -1),
                               ROW: F.col("_metadata.row_index")})

    def _marks(self, ops: list[Op], kind: str) -> DataFrame | None:
        """The (file, row) or (file) marks of the operations, None if there are none."""
        paths = [f"{self._op_path(o)}/_{kind}" for o in ops if getattr(o, kind)]
        schema = f"{FILE} string, {ROW} long" if kind == "gone" else f"{FILE} string"
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    @staticmethod
    def _unmarked(df: DataFrame, gone: DataFrame, ops: list[Op]) -> DataFrame:
        """``df`` (located) less the marked rows. File names make marks tiny as Parquet and large in
        memory, so Spark's size of them would broadcast millions: beyond ``BROADCAST_MARKS``, counted by
        the operations' names, both sides are sorted, which spills."""
        many = sum(o.gone for o in ops) > BROADCAST_MARKS
        return df.join(gone.hint("merge") if many else gone, [FILE, ROW], "left_anti")

    def _hide(self, df: DataFrame, ops: list[Op], located: bool = False) -> DataFrame:
        """``df`` (straight from ``_rows``) less the rows and files marked by ``ops``:
        anti-joins, and none where nothing is marked."""
        gone, dead = self._marks(ops, "gone"), self._marks(ops, "dead")
        if gone is None and dead is None and not located:
            return df
        cols = df.columns
        df = self._located(df)
        if dead is not None:
            df = df.join(dead, FILE, "left_anti")
        if gone is not None:
            df = self._unmarked(df, gone, ops)
        return df.select(*cols, FILE, ROW) if located else df.select(*cols)

    def read(self, as_of: int | None = None) -> DataFrame:
        """Visible rows, now or as of an operation number."""
        ops = self.live_ops(as_of)
        return self._hide(self._rows(ops), ops).select(*self.schema.names)

    def base(self) -> DataFrame:
        """All rows in the live folders, deleted ones included."""
        return self._rows(self.live_ops()).select(*self.schema.names)

    def tombstones(self) -> DataFrame:
        """Marks of deleted rows whose files still count: (file, row)."""
        ops = self.live_ops()
        gone, dead = self._marks(ops, "gone"), self._marks(ops, "dead")
        if gone is None:
            return self.spark.createDataFrame([], f"{FILE} string, {ROW} long")
        return gone if dead is None else gone.join(dead, FILE, "left_anti")

    def stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        """Rows added to the table, as a stream (``readStream.table``): rows deleted before a
        batch is read are left out, rows that a rewrite moves to new files are not sent again.
        Rows must be read before ``vacuum`` removes the files a rewrite replaced."""
        r = self.spark.readStream.schema(self._schema_with_op())
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        moved = "|".join(x.replace(" ", "_") for x in (OP_REORG, OP_OPTIMIZE))
        df = r.parquet(self.data_path()).filter(~F.col(OP).rlike(rf"^\d+\.({moved})\."))
        ops = self.ops()
        gone = self._marks(ops, "gone")
        if gone is not None:
            df = self._unmarked(self._located(df), gone, ops)
        return df.select(*self.schema.names)

    # --- writing ------------------------------------------------------------

    def _project(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.schema.names if c not in df.columns]
        if missing:
            raise ValueError(f"rows lack table columns {missing}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields])

    def _write_rows(self, df: DataFrame, path: str, rebalance: bool = True, **counted: Column) -> dict:
        """Write rows into ``path``; returns their number and that of each counted condition."""
        obs = Observation()
        out = self._project(df)
        if rebalance and self.partition_by:
            # few large files per table partition; AQE splits a heavy one
            out = out.hint("rebalance", *[F.col(f"`{c}`") for c in self.partition_by])
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(c).alias(n) for n, c in counted.items()])
        w = out.write.mode("overwrite").option("maxRecordsPerFile", str(MAX_RECORDS_PER_FILE))
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(path)
        return {k: int(v or 0) for k, v in obs.get.items()}

    def _stage(self) -> str:
        return f"{self.data_path()}/_new-{uuid.uuid4().hex[:12]}"

    def _commit(self, operation: str, rows: DataFrame | None = None, gone: DataFrame | None = None,
                dead: DataFrame | None = None, full: bool = False, txn: str = "",
                staged: tuple[str, int] | None = None, rebalance: bool = True) -> Op:
        """Write an operation to a hidden folder, then rename it into place."""
        path, n = staged or (self._stage(), 0)
        if rows is not None:
            n = self._write_rows(rows, path, rebalance)["rows"]
        elif staged is None:
            files.mkdirs(self.spark, path)
        counts = {}
        for kind, marks in (("gone", gone), ("dead", dead)):
            counts[kind] = 0
            if marks is not None:
                obs = Observation()
                (marks.observe(obs, F.count(F.lit(1)).alias("n"))
                 .write.mode("overwrite").parquet(f"{path}/_{kind}"))
                counts[kind] = int(obs.get["n"])
        known = self.ops()
        op = Op(known[-1].seq + 1 if known else 0, operation, n, **counts, full=full, txn=txn)
        files.rename(self.spark, path, self._op_path(op))
        if self.name:
            self.register(self.name)
        return op

    def append(self, df: DataFrame, operation: str = OP_WRITE,
               txn: tuple[str, int] | None = None, merge_schema: bool = False) -> int:
        """Append rows; returns how many. ``txn=(stream, batch)`` names a stream batch: its
        folder appears at once or not at all, so a replay finds it and adds nothing, and a
        batch that died half-way is written anew.

        ``merge_schema=True``: columns of ``df`` unknown to the table become nullable columns
        (older files read them as NULL); table columns that ``df`` lacks are written as NULL."""
        mark = ""
        if txn is not None:
            mark = f"{uuid.uuid5(uuid.NAMESPACE_URL, txn[0]).hex}-{int(txn[1])}"
            if any(o.txn == mark for o in self.ops()):
                return 0
        if merge_schema:
            known = set(self.schema.names)
            added = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name not in known]
            if added:
                self.schema = T.StructType([*self.schema.fields, *added])
                self._write_meta(self.version() + 1)
            df = df.select(*[F.col(f.name) if f.name in df.columns
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return self._commit(operation, df, txn=mark).rows

    def insert(self, rows: DataFrame, defaults: dict[str, Column | str] | None = None,
               identity: str | None = None, order_by: list[str | Column] | None = None) -> int:
        """``INSERT INTO t (columns of rows)``: omitted columns take their default (an expression
        such as ``current_timestamp()`` is evaluated once per insert) or NULL; NULLs of the
        ``identity`` column are numbered on from the table's largest value."""
        df = mutate.apply_defaults(rows, self.schema, defaults, keep=order_by)
        if identity:
            top = self.read().agg(F.max(identity)).first()[0]
            df = mutate.assign_identity(df, identity, order_by=order_by, current_max=top)
        return self._commit(OP_WRITE, df).rows

    def merge_insert_only(self, updates: DataFrame, txn: tuple[str, int] | None = None,
                          key_implies_partition: bool = False,
                          key_implies: list[str] | None = None, once: bool = False) -> int:
        """``MERGE … WHEN NOT MATCHED THEN INSERT *``: append rows with new keys only, with ``once``
        one row of each key (``merge.one_per_key``) where the updates repeat it.

        ``key_implies`` names columns whose value is fixed by the key (those a content key
        hashes); ``key_implies_partition=True`` adds the partition columns. A target row can
        then match only if those columns agree with some batch row, so the target scan is
        narrowed to the batch's partitions and to literal [min, max] ranges that Parquet
        statistics use to skip files. The result is the same."""
        implied = list(key_implies or [])
        if key_implies_partition:
            implied += [c for c in self.partition_by if c not in implied]
        target = self.read()
        if implied:
            scope = self._implied_scope(updates, implied)
            if scope is None:
                return self.append(updates.limit(0), operation=OP_MERGE, txn=txn)
            target = target.filter(scope)
        new = merge_ops.rows_to_insert(target, updates, self.key, self.schema.names, once)
        return self.append(new, operation=OP_MERGE, txn=txn)

    def _partition_filter(self, parts: list[tuple]) -> Column:
        """Rows in the given partitions, as a flat partition filter; NULL values NULL-safe."""
        cols = self.partition_by
        plain = [p for p in parts if all(v is not None for v in p)]
        terms = []
        if plain and len(cols) == 1:
            terms.append(F.col(cols[0]).isin([p[0] for p in plain]))
        elif plain:
            terms.append(F.struct(*cols).isin(
                [F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, p)]) for p in plain]))
        for p in parts:
            if any(v is None for v in p):
                terms.append(reduce(lambda a, b: a & b,
                                    [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, p)]))
        return reduce(lambda a, b: a | b, terms)

    def _implied_scope(self, updates: DataFrame, implied: list[str]) -> Column | None:
        """Filter on the target implied by the batch's values (None: the batch is empty). The
        driver receives one row of bounds, and one row per table partition the batch touches, up
        to ``SCOPE_PARTITIONS``; a batch that touches more is bounded by the range of each
        partition column instead (the filter only saves reading: the result is the same).
        Bounds go through Spark's own text form, so they are exact in any session time zone."""
        conds = []
        ranged = [c for c in implied if c not in self.partition_by]
        parts = None
        if self.partition_by and all(c in implied for c in self.partition_by):
            parts = [tuple(r) for r in updates.select(*self.partition_by).distinct().take(SCOPE_PARTITIONS + 1)]
            if not parts:
                return None
        if parts and len(parts) <= SCOPE_PARTITIONS:
            conds.append(self._partition_filter(parts))
        else:
            ranged = list(implied)
        if ranged:
            aggs = []
            for c in ranged:
                aggs += [F.min(c).cast("string"), F.max(c).cast("string"),
                         F.max(F.col(c).isNull().cast("int"))]
            row = updates.agg(*aggs).first()
            if row[2] is None:          # no rows at all
                return None
            for i, c in enumerate(ranged):
                lo, hi, has_null = row[3 * i], row[3 * i + 1], row[3 * i + 2]
                dtype = self.schema[c].dataType
                cond = (F.col(c).between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype))
                        if lo is not None else F.lit(False))
                conds.append(cond | F.col(c).isNull() if has_null else cond)
        return reduce(lambda a, b: a & b, conds)

    def _visible_located(self, as_of: int | None = None) -> DataFrame:
        ops = self.live_ops(as_of)
        return self._hide(self._rows(ops), ops, located=True)

    def upsert(self, updates: DataFrame) -> None:
        """``MERGE … WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``: the source is written
        once; its keys, read back, mark the rows it replaces."""
        path = self._stage()
        n = self._write_rows(updates, path)["rows"]
        src = self.spark.read.schema(self.schema).parquet(path)
        try:
            merge_ops.check_unique_keys(src, self.key)
        except ValueError:
            files.delete(self.spark, path)
            raise
        matched = self._visible_located().join(src.select(*self.key), self.key, "left_semi")
        self._commit(OP_MERGE, gone=matched.select(FILE, ROW), staged=(path, n))

    def delete(self, pred: Column | str) -> int:
        """``DELETE FROM t WHERE pred`` (a NULL predicate keeps the row): one pruned scan and
        one small write of marks. ``purge`` removes the rows from the files."""
        hit = self._visible_located().filter(is_true(as_column(pred)))
        return self._commit(OP_DELETE, gone=hit.select(FILE, ROW)).gone

    def replace_where(self, pred: Column | str, new_rows: DataFrame) -> None:
        """``INSERT INTO t REPLACE WHERE pred (new_rows)``: one operation, all or nothing.
        New rows must satisfy ``pred``; they may be computed from the table."""
        p = as_column(pred)
        path = self._stage()
        got = self._write_rows(new_rows, path, stray=~is_true(p))
        if got["stray"]:
            files.delete(self.spark, path)
            raise ValueError("replace_where: some new rows do not satisfy the predicate")
        hit = self._visible_located().filter(is_true(p))
        self._commit(OP_WRITE, gone=hit.select(FILE, ROW), staged=(path, got["rows"]))

    # --- maintenance ----------------------------------------------------------

    def _rewrite_files(self, operation: str, names: DataFrame, shape=lambda df: df,
                       rebalance: bool = True) -> None:
        """Write the visible rows of the named files anew, and mark those files as replaced."""
        names = names.select(FILE).distinct()
        rows = shape(self._visible_located().join(names, FILE, "left_semi").select(*self.schema.names))
        self._commit(operation, rows, dead=names, rebalance=rebalance)
        self.vacuum()

    def purge(self, where: Column | str | None = None) -> None:
        """``REORG TABLE t [WHERE partition-pred] APPLY (PURGE)``: rewrite the files (matching
        ``where``) that hold deleted rows. Visible rows do not change."""
        marked = self.tombstones().select(FILE).distinct()
        ops = self.live_ops()
        scope = self._rows(ops)
        if where is not None:
            scope = scope.filter(as_column(where))
        self._rewrite_files(OP_REORG, self._located(scope).select(FILE).join(marked, FILE, "left_semi"))

    def cluster_by(self, time_column: str, num_ranges: int | None = None,
                   where: Column | str | None = None) -> None:
        """``OPTIMIZE t [WHERE partition-pred] ZORDER BY (time_column)``: rows range-partitioned
        and sorted by (partition columns, time), ranges of about ``CLUSTER_BYTES``; the whole
        table, or the files of the partitions that ``where`` selects."""
        n = num_ranges or max(1, -(-files.total_bytes(self.spark, self.data_path()) // CLUSTER_BYTES),
                              self.spark.sparkContext.defaultParallelism)

        def shape(df):
            return cluster_by_time(df, self.partition_by, time_column, n)

        if where is None:
            self._commit(OP_OPTIMIZE, shape(self.read()), full=True, rebalance=False)
            self.vacuum()
        else:
            scope = self._rows(self.live_ops()).filter(as_column(where))
            self._rewrite_files(OP_OPTIMIZE, self._located(scope).select(FILE), shape, rebalance=False)

    def vacuum(self) -> bool:
        """Remove files that rewrites replaced, unless a snapshot is live (then nothing)."""
        if files.list_children(self.spark, f"{self.data_path()}/_pins"):
            return False
        live = self.live_ops()
        for o in self.ops():
            if o.seq < live[0].seq:
                for child in files.list_children(self.spark, self._op_path(o)):
                    files.delete(self.spark, f"{self._op_path(o)}/{child}")
        dead = self._marks(live, "dead")
        if dead is not None:
            for r in dead.toLocalIterator():        # one file name at a time
                files.delete(self.spark, f"{self.data_path()}/{OP}={r[FILE]}")
        return True

    # --- copies, snapshots and metadata -----------------------------------------

    def deep_clone(self, root: str, replace: bool = False) -> ParquetTable:
        """``CREATE TABLE c CLONE t``: an independent copy of the visible rows. The source's files
        hold one partition each, so rows are written by the tasks that read them, in the order of
        the files (a clone of clustered files stays clustered), without a shuffle."""
        return ParquetTable.create_as(self.spark, root, self.read(), self.partition_by,
                                      self.key, replace=replace, operation=OP_CLONE, rebalance=False)

    def snapshot(self) -> Snapshot:
        """``SHALLOW CLONE``: the table as of now. It holds a number, no files; while it is
        live (until ``release``) replaced files stay."""
        seq = self.version()
        pin = f"{self.data_path()}/_pins/{seq}-{uuid.uuid4().hex[:12]}"
        files.mkdirs(self.spark, pin)
        return Snapshot(self, seq, pin)

    def register(self, name: str) -> DataFrame:
        """Publish the visible rows in the catalog as ``name`` (``CREATE TABLE … LIKE … COPY
        LOCATION``): an external table ``<name>_files_<version>`` over the same files, and a view
        of its visible rows. Each later operation makes them anew (other sessions may hold what
        an old name meant)."""
        if self.name != name:
            self.name = name
            self._write_meta(self.version() + 1)
        ops, old = self.live_ops(), self._registered_files(name)
        raw = f"{name}_files_{ops[-1].seq}"
        fields = [*self.schema.fields, T.StructField(OP, T.StringType())]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = ", ".join(f"`{c}`" for c in [OP, *self.partition_by])
        self.spark.sql(f"DROP TABLE IF EXISTS {raw}")
        self.spark.sql(f"CREATE TABLE {raw} ({cols}) USING parquet PARTITIONED BY ({parts}) LOCATION '{self.data_path()}'")
        self.spark.sql(f"ALTER TABLE {raw} RECOVER PARTITIONS")
        sql = (f"SELECT {', '.join(f'b.`{c}`' for c in self.schema.names)} FROM (SELECT *, "
               f"substring_index(_metadata.file_path, '/{OP}=', -1) AS {FILE}, _metadata.row_index AS {ROW} "
               f"FROM {raw} WHERE {OP} >= '{ops[0].name}') b")
        for kind, on in (("gone", f"b.{FILE} = x{{i}}.{FILE} AND b.{ROW} = x{{i}}.{ROW}"), ("dead", f"b.{FILE} = x{{i}}.{FILE}")):
            marks = [f"SELECT * FROM parquet.`{self._op_path(o)}/_{kind}`" for o in ops if getattr(o, kind)]
            if marks:
                sql += f" LEFT ANTI JOIN ({' UNION ALL '.join(marks)}) x{kind} ON {on.format(i=kind)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('tidepool.root' = '{self.root}', "
                       f"'tidepool.files' = '{raw}') AS {sql}")
        if old and old != raw:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        return self.spark.table(name)

    def _registered_files(self, name: str) -> str | None:
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        return {r["key"]: r["value"] for r in rows}.get("tidepool.files")

    def unregister(self) -> None:
        """Take the table's name out of the catalog; the files stay."""
        if self.name:
            raw = self._registered_files(self.name)
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
            self.spark.sql(f"DROP TABLE IF EXISTS {raw}")
            self.name = None
            self._write_meta(self.version() + 1)

    def as_view(self, name: str, global_view: bool = False) -> DataFrame:
        """Publish the visible rows for SQL: a session view, or a global one
        (``global_temp.<name>``) that SQL in another session can read."""
        df = self.read()
        (df.createOrReplaceGlobalTempView if global_view else df.createOrReplaceTempView)(name)
        return df

    def changes_since(self, snapshot: Snapshot) -> DataFrame:
        """Row changes since a snapshot (insert, delete, update pre/post image) by table key:
        only rows that later operations marked or added are compared. After a full rewrite
        both versions are."""
        later = [o for o in self.ops() if o.seq > snapshot.seq]
        if any(o.full for o in later):
            return change_ops.change_feed(snapshot.read(), self.read(), self.key)
        cols, ops = self.schema.names, self.live_ops()
        old = self._visible_located(snapshot.seq)
        parts = [old.join(m.distinct(), [c for c in (FILE, ROW) if c in m.columns], "left_semi")
                 for m in (self._marks(later, "gone"), self._marks(later, "dead")) if m is not None]
        before = reduce(DataFrame.unionByName, parts).distinct() if parts else old.limit(0)
        added = self._rows(later) if later else self._rows(ops).limit(0)
        return change_ops.change_feed(before.select(*cols), self._hide(added, ops).select(*cols), self.key)

    def history(self) -> DataFrame:
        """``DESCRIBE HISTORY``, newest first: version, operation, rows added and deleted."""
        rows = [(o.seq, o.operation, o.rows, o.gone) for o in reversed(self.ops())]
        return self.spark.createDataFrame(
            rows, "version long, operation string, num_output_rows long, num_deleted_rows long")

    def files(self) -> DataFrame:
        """The data files that count, from a file listing (no file is opened): the partition
        columns as text, ``file`` and ``bytes``."""
        found = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(self.data_path())
                 .select(F.substring_index("path", f"/{OP}=", -1).alias(FILE), F.col("length").alias("bytes")))
        ops = self.live_ops()
        dead = self._marks(ops, "dead")
        found = found.filter(F.col(FILE) >= ops[0].name)
        if dead is not None:
            found = found.join(dead, FILE, "left_anti")
        return found.select(*[F.regexp_extract(FILE, f"/{c}=([^/]*)", 1).alias(c) for c in self.partition_by],
                            F.col(FILE).alias("file"), "bytes")

    def base_files(self) -> DataFrame:
        """The files as the rows see them: partition columns, size and rows of each."""
        rows = self._rows(self.live_ops()).select(*self.partition_by, "_metadata.file_path", "_metadata.file_size")
        return rows.groupBy(*self.partition_by, "file_path").agg(
            F.max("file_size").alias("size"), F.count(F.lit(1)).alias("rows"))

    def detail(self) -> dict:
        """``DESCRIBE DETAIL``: location, partition columns, files, bytes, marks, version."""
        f = self.files().agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                             *([F.countDistinct(F.struct(*self.partition_by)).alias("parts")] if self.partition_by else [])).first()
        return {"location": self.data_path(), "partitionColumns": list(self.partition_by),
                "numFiles": int(f["n"]), "sizeInBytes": int(f["bytes"]),
                "numPartitions": int(f["parts"]) if self.partition_by else 0,
                "numTombstones": self.tombstones().count(), "version": self.version()}

    def partition_counts(self) -> DataFrame:
        """Visible rows per partition."""
        return self.read().groupBy(*self.partition_by).agg(F.count(F.lit(1)).alias("num_rows"))


class Snapshot:
    """A table as of one operation; unaffected by all later ones until released."""

    def __init__(self, table: ParquetTable, seq: int, pin: str):
        self.table, self.seq, self.pin = table, seq, pin

    def read(self) -> DataFrame:
        return self.table.read(as_of=self.seq)

    def release(self) -> None:
        files.delete(self.table.spark, self.pin)
