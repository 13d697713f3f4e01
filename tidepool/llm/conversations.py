"""Conversation structure repair: the cheapest edits that make role initials ``(s?(ua)+)?``.

Rows are taken by (turn, nulls first; role; digest of the text). A row is one symbol: its role's initial
and its first fault (blank, duplicate, truncated). Edits: keep (0), rerole (2), delete (3; blank and
duplicate rows must go), insert an empty user or assistant row (2); a truncated row that stays adds 1.

Method: run-length dynamic programming over four states (nothing yet, after s, after u, after a). Equal
consecutive symbols collapse into runs; one symbol is a 4 x 4 min-plus matrix; a run advances the costs
by the cached binary powers of its matrix. Then the choices are unrolled for the audit: at each row the
least letter (D, I, K, R) that still reaches the least cost.

Min-plus products are associative, so a conversation of any length is cut into chunks of at most
``CHUNK`` distinct rows, in order. Every chunk becomes one matrix; a pass over a conversation's
matrices gives the costs to go at each chunk's end; chunks are unrolled apart, from each state they
may begin in; a pass over their ends picks the one that happened. Equal rows of a conversation are
counted before they are moved, and texts travel only for rows that stay. What is sequential by its
contract is one conversation's audit (one text) and its hash (a stream through one task, never held).

Defined cases: null roles and texts count as one space; equal rows of one turn stand next to each other;
rows with a null id are one conversation; a conversation without rows has zeros, an empty audit and the hash
of the empty text (ids come from ``ids``); an empty table gives an empty result; texts of any length
are read whole; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import staged

# The damage of the query, white space, ends of a sentence, costs of the edits.
DAMAGES = 20
WORD, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

CHUNK = 4096
ROW_BITS = 33       # bits of monotonically_increasing_id() that hold the row's place in its partition
FAR = 1 << 40       # no path; two of them add up without overflow
START, SYSTEM, USER, ASSISTANT = range(4)       # states, and classes of role initials (0: any other)
EMITTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}     # what may come next, from each state
GONE = 0            # symbol of a row that must be deleted; 1 + class, or 5 + class if truncated, for others


# --- the automaton ---------------------------------------------------------------

def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a 4 x 4 matrix with a matrix or a vector."""
    return np.minimum((a[:, :, None] + b[None]).min(1) if b.ndim == 2 else (a + b).min(1), FAR)


def inserts() -> np.ndarray:
    """Least cost of insertions between two states."""
    out = np.full((4, 4), FAR, np.int64)
    for x in range(4):
        out[x, x], y = 0, x
        for k in (1, 2, 3):
            y = EMITTED[y]
            out[x, y] = min(out[x, y], INSERT * k)
    return out


INSERTS = inserts()
ACCEPT = times(INSERTS, np.array([0, FAR, FAR, 0], np.int64))


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(script letter, cost, next state) of the edits of one row, by audit letter: D, K, R."""
    out = [("D", DELETE, state)]
    if symbol == GONE:
        return out
    role, more = (symbol - 1) % 4, TRUNCATED if symbol > 4 else 0
    follows = EMITTED[state]
    if role == follows or (role == SYSTEM and state == START):
        out.append(("K", more, role))
    out.append(("U" if follows == USER else "A", REROLE + more, follows))
    return out


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def power(symbol: int, k: int) -> np.ndarray:
    """The matrix of 2**k equal symbols (insertions before each), cached."""
    got = _POWERS.get((symbol, k))
    if got is None:
        if k == 0:
            row = np.full((4, 4), FAR, np.int64)
            for x in range(4):
                for _, cost, y in choices(symbol, x):
                    row[x, y] = min(row[x, y], cost)
            got = times(INSERTS, row)
        else:
            got = times(power(symbol, k - 1), power(symbol, k - 1))
        _POWERS[(symbol, k)] = got
    return got


def before_run(symbol: int, length: int, to_go: np.ndarray) -> np.ndarray:
    """Costs to go (a vector, or one for each column) before a run, from those after it."""
    k = 0
    while length:
        if length & 1:
            to_go = times(power(symbol, k), to_go)
        length, k = length >> 1, k + 1
    return to_go


def runs_of(head: np.ndarray, role: np.ndarray, copies: np.ndarray) -> list[tuple[int, int]]:
    """(symbol, length) of the rows: ``head`` 0 if all copies must go, 1 if the first may stay, 2 if it is truncated."""
    out: list[list[int]] = []
    for h, r, n in zip(head.tolist(), role.tolist(), copies.tolist(), strict=True):
        if h:
            s = 1 + r + (4 if h == 2 else 0)
            if out and out[-1][0] == s:
                out[-1][1] += 1
            else:
                out.append([s, 1])
            n -= 1
        if n:
            if out and out[-1][0] == GONE:
                out[-1][1] += n
            else:
                out.append([GONE, n])
    return [(s, n) for s, n in out]


def matrix_of(runs: list[tuple[int, int]]) -> np.ndarray:
    """Costs from each state before the runs to each state after them."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for s, n in reversed(runs):
        out = before_run(s, n, out)
    return out


def to_go_between(runs: list[tuple[int, int]], after: np.ndarray) -> list[np.ndarray]:
    """Costs to go at the end of every run."""
    out = [after]
    for s, n in reversed(runs[1:]):
        out.append(before_run(s, n, out[-1]))
    return out[::-1]


def unroll(runs: list[tuple[int, int]], ends: list[np.ndarray], state: int) -> tuple[list[str], int]:
    """The script of every row, from ``state``: insertions (``u``, ``a``) before it and its edit (``K`` keep,
    ``U``/``A`` rerole, ``D`` delete); and the state after the last. A run of rows to delete is one item."""
    out = []
    for (symbol, n), after in zip(runs, ends, strict=True):
        if symbol == GONE:      # D is the least letter, and insertions can wait
            out.append("D" * n)
            continue
        costs = [after.tolist()]
        one = power(symbol, 0)
        for _ in range(n):
            costs.append(times(one, np.array(costs[-1])).tolist())
        for i in range(n, 0, -1):
            script = ""
            while True:
                (first, price, same), *rest = choices(symbol, state)
                here, later = costs[i], costs[i - 1]
                if price + later[same] == here[state]:
                    script += first
                    break
                follows = EMITTED[state]
                if INSERT + here[follows] == here[state]:
                    script, state = script + ("u" if follows == USER else "a"), follows
                    continue
                script, state = next((script + c, y) for c, price, y in rest if price + later[y] == here[state])
                break
            out.append(script)
    return out, state


def last_inserts(state: int) -> str:
    return {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[state]


def scripts_of(head: np.ndarray, role: np.ndarray, copies: np.ndarray, after: np.ndarray, state: int,
               last: bool) -> tuple[list[str], int]:
    """The script of every entry (a row and its copies) of a chunk, and the state after it."""
    runs = runs_of(head, role, copies)
    items, state = unroll(runs, to_go_between(runs, after) if runs else [], state)
    single, taken, out = iter(items), 0, []
    gone = ""
    for h, n in zip(head.tolist(), copies.tolist(), strict=True):
        script = ""
        if h:
            script, n = next(single), n - 1
        if n:       # entries share the D's of one run
            if taken == len(gone):
                gone, taken = next(single), 0
            script, taken = script + "D" * n, taken + n
        out.append(script)
    if last and out:
        out[-1] += last_inserts(state)
    return out, state


# --- rows ------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """The query's damage, by crc32(conv_id:turn) modulo 20: rows dropped, emptied, stripped of their ends
    of sentences, repeated, or given to the user."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % DAMAGES
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(some("text"), "[.!?]", "")).otherwise(some("text"))
    role = F.when(k == 4, "user").otherwise(some("role"))
    out = rows.filter(k != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                     F.when(k == 3, 2).otherwise(1).alias("n"))
    return out.withColumn("n", F.explode(F.sequence(F.lit(1), "n"))).drop("n")


def plain(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two, and the text's digest."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", "turn", some("role"), some("text")).withColumn("digest", F.md5(F.col("text").cast("binary")))


def entries(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one entry: their number ``c``, whether the first is the first of its role and
    text in the conversation, and the faults. Counted before the shuffle; texts stay where they are."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(START)
    text = F.col("text")
    counted = (rows.select("conv_id", "turn", "role", "digest", (~text.rlike(WORD)).alias("blank"), (~text.rlike(ENDED)).alias("cut"))
               .groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("c")))
    again = (counted.groupBy("conv_id", "role", "digest").agg(
        F.count(F.lit(1)).alias("m"), F.max(F.col("turn").isNull()).alias("no_turn"), F.min("turn").alias("first_turn"))
        .filter("m > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "no_turn", "first_turn"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    first = F.when(F.col("_role").isNull(), True).when(F.col("no_turn"), F.col("turn").isNull()).otherwise(
        F.coalesce(F.col("turn") == F.col("first_turn"), F.lit(False)))
    out = counted.join(again, same, "left").withColumn("first", first)
    head = F.when(F.col("blank") | ~F.col("first"), 0).when(F.col("cut"), 2).otherwise(1)
    return staged(out.select("conv_id", "turn", "role", "digest", "c", "blank", "first", role.cast("int").alias("cls"),
                             head.cast("int").alias("head")), "conversation-entries")


def statistics(entry: DataFrame) -> DataFrame:
    """Per conversation: gaps in the turns, and the rows of each first fault."""
    c, alone = F.col("c"), F.when(F.col("first"), 1).otherwise(0)
    turns = entry.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), c).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), c - alone).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("head") == 2, 1).otherwise(0)).alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
                                        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])


def chunks(entry: DataFrame) -> DataFrame:
    """The entries in order, in chunks of at most ``CHUNK`` of one conversation: (conv_id, chunk, rows).
    Range partitions keep the order, so a chunk's first row id orders the chunks of all partitions."""
    order = ["conv_id", "turn", "role", "digest"]
    n = int(entry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(entry.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()), "conversation-order")
    row = F.struct("at", "turn", "role", "digest", "cls", "c", "head")
    block = F.floor(F.col("at") / CHUNK).alias("block")     # a partition's ids are consecutive
    return (placed.groupBy("conv_id", F.shiftright("at", ROW_BITS).alias("part"), block)
            .agg(F.min("at").alias("chunk"), F.sort_array(F.collect_list(row)).alias("rows")).drop("part", "block"))


def each_list(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(head, role class, copies) of every row's list of entries."""
    flat, ends = column.flatten(), np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    parts = [flat.field(flat.type.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("head", "cls", "c")]
    start = 0
    for end in ends.tolist():
        yield tuple(p[start:end] for p in parts)
        start = end


def summarised(chunk: DataFrame) -> DataFrame:
    """Chunks with their min-plus matrix, the role classes at both ends, and illegal neighbours inside."""
    schema = T.StructType([*chunk.schema.fields, T.StructField("matrix", T.ArrayType(T.LongType())),
                           *[T.StructField(n, T.LongType()) for n in ("begins", "ends", "illegal")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for head, role, copies in each_list(batch.column("rows")):
                bad = int((copies - 1).sum()) + sum(not legal(a, b) for a, b in zip(role[:-1].tolist(), role[1:].tolist()))
                for column, value in zip(out, (matrix_of(runs_of(head, role, copies)).ravel(), int(role[0]), int(role[-1]), bad)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out[0], pa.list_(pa.int64())), *[pa.array(x, pa.int64()) for x in out[1:]]], schema.names)

    return staged(chunk.mapInArrow(run, schema), "conversation-chunks")


def legal(a: int, b: int) -> bool:
    return (a, b) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def costs(summary: DataFrame) -> DataFrame:
    """Per conversation: ``cost``, ``illegal``, and for each chunk the costs to go at its end (``to_go``).
    One row a chunk of ``CHUNK`` rows is brought together, not the rows."""
    one = F.struct("chunk", "matrix", "begins", "ends", "illegal")
    gathered = summary.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("all"))
    piece = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("to_go", T.ArrayType(T.LongType())),
                          T.StructField("first", T.BooleanType()), T.StructField("last", T.BooleanType())])
    schema = T.StructType([summary.schema["conv_id"], T.StructField("cost", T.LongType()), T.StructField("illegal", T.LongType()),
                           T.StructField("pieces", T.ArrayType(piece))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost, illegal, pieces = [], [], []
            for all_ in batch.column("all").to_pylist():
                to_go, mine = ACCEPT, []
                for i in range(len(all_) - 1, -1, -1):
                    mine.append({"chunk": all_[i]["chunk"], "to_go": to_go.tolist(), "first": i == 0, "last": i == len(all_) - 1})
                    to_go = times(np.array(all_[i]["matrix"]).reshape(4, 4), to_go)
                cost.append(int(to_go[START]))
                illegal.append(sum(x["illegal"] for x in all_) + sum(not legal(x["ends"], y["begins"]) for x, y in zip(all_[:-1], all_[1:])))
                pieces.append(mine)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64()),
                                              pa.array(pieces, pa.list_(pa.struct([
                                                  ("chunk", pa.int64()), ("to_go", pa.list_(pa.int64())), ("first", pa.bool_()), ("last", pa.bool_())])))],
                                             schema.names)

    return staged(gathered.mapInArrow(run, schema), "conversation-costs")


def solved(summary: DataFrame, cost: DataFrame) -> DataFrame:
    """Every chunk with the scripts of its rows, in the state that it really begins in."""
    piece = cost.select(F.explode("pieces").alias("p")).select(F.col("p.chunk").alias("_chunk"), "p.to_go", "p.first", "p.last")
    known = summary.select("conv_id", "chunk", "rows").join(piece, F.col("chunk") == F.col("_chunk")).drop("_chunk")
    schema = T.StructType([*known.schema.fields, T.StructField("after", T.ArrayType(T.IntegerType())),
                           T.StructField("scripts", T.ArrayType(T.ArrayType(T.StringType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to_go, first, last = (batch.column(n).to_pylist() for n in ("to_go", "first", "last"))
            after, scripts = [], []
            for i, rows in enumerate(each_list(batch.column("rows"))):
                got = [scripts_of(*rows, np.array(to_go[i]), s, last[i]) for s in ((START,) if first[i] else range(4))]
                scripts.append([g[0] for g in got])
                after.append([g[1] for g in got])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(after, pa.list_(pa.int32())),
                                              pa.array(scripts, pa.list_(pa.list_(pa.string())))], schema.names)

    each = staged(known.mapInArrow(run, schema), "conversation-scripts")
    # Conversations of several chunks: follow the states from chunk to chunk.
    several = each.filter("NOT (first AND last)").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "after"))).alias("all"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for all_ in batch.column("all").to_pylist():
                chunk, begins, state = [], [], START
                for x in all_:
                    chunk.append(x["chunk"])
                    begins.append(state)
                    state = x["after"][state]
                yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(begins, pa.int32())], ["_chunk", "begins"])

    begins = several.mapInArrow(follow, "_chunk long, begins int")
    return (each.join(begins, F.col("chunk") == F.col("_chunk"), "left")
            .select("conv_id", "chunk", "rows", F.col("scripts")[F.coalesce("begins", F.lit(START))].alias("scripts")))


def repaired_rows(rows: DataFrame, chunk: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, their place (at, i), role and text."""
    each = (chunk.select("conv_id", F.explode(F.arrays_zip("rows", "scripts")).alias("x"))
            .select("conv_id", "x.rows.at", "x.rows.turn", "x.rows.role", "x.rows.digest", F.translate("x.scripts", "D", "").alias("script"))
            .filter("script != ''"))
    texts = (rows.groupBy("conv_id", "turn", "role", "digest").agg(F.any_value("text").alias("text"))
             .select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "role", "digest")], "text"))
    same = (F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("turn").eqNullSafe(F.col("_turn"))
            & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")))
    with_text = each.filter("script rlike '[KUA]'").join(texts, same, "left").select("conv_id", "at", "role", "script", "text")
    only_inserts = each.filter("NOT script rlike '[KUA]'").select("conv_id", "at", "role", "script", F.lit(None).cast("string").alias("text"))
    letters = with_text.unionByName(only_inserts).select(
        "conv_id", "at", F.posexplode(F.split("script", "")).alias("i", "edit"), F.col("role").alias("own"), "text").filter("edit != ''")
    role = (F.when(F.col("edit") == "K", F.col("own")).when(F.lower("edit") == "u", F.lit("user")).otherwise(F.lit("assistant")))
    return letters.select("conv_id", "at", "i", role.alias("role"),
                          F.when(F.col("edit").isin("K", "U", "A"), F.col("text")).otherwise("").alias("text"))


def hashes(lines: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines in order, streamed through sorted partitions."""
    schema = T.StructType([lines.schema["conv_id"], T.StructField("sha", T.StringType())])
    line = F.concat("role", F.lit(":"), "text").cast("binary").alias("line")
    ordered = (lines.select("conv_id", "at", "i", line).repartition("conv_id").sortWithinPartitions("conv_id", "at", "i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(id_: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([id_, pa.array([digest.hexdigest()])], ["conv_id", "sha"])

        last, digest = None, None
        for batch in batches:
            ids, texts = batch.column("conv_id"), batch.column("line")
            for i in range(len(batch)):
                if last is None or not last[0].equals(ids[i]):
                    if last is not None:
                        yield out(last)
                    last, digest = ids.slice(i, 1), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(texts[i].as_buffer())
        if last is not None:
            yield out(last)

    return ordered.select("conv_id", "line").mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations of ``rows`` (conv_id, turn, role, text) as rows, in order of (at, i)."""
    source = plain(rows)
    summary = summarised(chunks(entries(source)))
    return repaired_rows(source, solved(summary, costs(summary)))


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, least cost, audit and hash of each conversation of ``rows``, and of each id of ``ids`` (conv_id)."""
    source = plain(rows)
    entry = entries(source)
    summary = summarised(chunks(entry))
    cost = costs(summary)
    chunk = staged(solved(summary, cost), "conversation-solved")
    letters = F.translate(F.array_join("scripts", ""), "uaUA", "IIRR")
    audits = (chunk.select("conv_id", F.struct("chunk", letters.alias("a")).alias("x")).groupBy("conv_id")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["a"]), "").alias("audit")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [statistics(entry), cost.select("conv_id", "illegal", "cost"), audits, hashes(repaired_rows(source, chunk)),
             (ids if ids is not None else rows).select("conv_id").distinct()]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p, allowMissingColumns=True)
    out = all_.groupBy("conv_id").agg(*[F.max(n).alias(n) for n in (*numbers, "audit", "sha")])
    return out.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
