"""Mixing sources to target weights.

Documents of a source are laid end to end in a pseudorandom order and cut into
blocks of ``block`` tokens. Each output shard of ``shard_slots`` slots draws its
source counts from a multinomial. The slots of a source are numbered over all
shards; slot ``j`` reads block ``perm(j mod n_blocks)`` in pass ``j // n_blocks``,
where ``perm`` is a pseudorandom permutation (a Feistel network) of the source's block
indices.
Slots and blocks then meet in one equi-join on (source, block index).

A draw beyond a source's quota (its target) is handed to the sources whose draws
fell short, in order of their numbers, so every source ends on its quota. Passes
stay under ``max_repeat``, so no token is taken more often than that.

Defined cases: a null or empty text has size 0 and is never taken; null sources
form one source, last in order; equal rows are documents of their own; texts of any
length are counted whole; an empty table gives an empty result. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import staged

BLOCK, SHARD_SLOTS, SEED = 32, 4096, 20240
WEIGHTS, SHARE, MAX_REPEAT = (5.0, 2.0, 1.0), 1.5, 2.0
GAP = r"[\x20\x09-\x0D]+"  # fixed value: what lies between words
CHUNK_DOCS = 20_000


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE,
            max_repeat: float = MAX_REPEAT) -> list[float]:
    """Target tokens per source; ``sizes`` in source order. Water-filling: a source
    stops at ``max_repeat`` times its size, the excess goes to the others by weight."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = {i for i, n in enumerate(sizes) if n > 0}
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        part = {i: left * weights[i % len(weights)] / total for i in open_}
        full = {i for i in open_ if part[i] > max_repeat * sizes[i]}
        if not full:
            for i in open_:
                out[i] = part[i]
            break
        for i in full:
            out[i] = max_repeat * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key: a balanced Feistel network over
    the next even power of two, walked on until it falls below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask, n = (np.uint64(1) << half) - np.uint64(1), n.astype(np.uint64)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for r in range(rounds):
            z = (right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def block_indices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, slot, sid, blocks, j) to (shard, slot, sid, idx)."""
    for batch in batches:
        shard, slot, sid, blocks, j = (batch.column(i) for i in range(5))
        n, s = blocks.to_numpy(), sid.to_numpy().astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [shard, slot, sid, pa.array(permute(j.to_numpy() % n, n, s + SEED))], ["shard", "slot", "sid", "idx"])


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(text, GAP), ""), F.array().cast("array<string>"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the document's first token position in its source.

    Prefix sums in two levels: documents fall by hash into chunks of about
    ``CHUNK_DOCS``, so a source with a third of all rows spreads over many tasks;
    only one row per (source, chunk) meets in the second level.
    """
    base = docs.select(
        "doc_id", "source",
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.xxhash64("doc_id", "text").alias("rid"))
    base = staged(base, "mix-sizes")
    chunks = base.count() // CHUNK_DOCS + 1
    base = base.withColumn("chunk", F.pmod("rid", F.lit(chunks)))
    per = base.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("s2"), F.col("chunk").alias("c2"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start0"))
    inside = (Window.partitionBy("source", "chunk").orderBy("rid", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    base = base.withColumn("upto", F.sum("size").over(inside)).withColumn("copy", F.row_number().over(inside))
    return (base.join(per, F.col("source").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
            .select("doc_id", "source", "size", "rid", "copy",
                    (F.col("start0") + F.col("upto") - F.col("size")).alias("start")))


def quotas(size_of: list[tuple], block: int, target: list[float]) -> list[dict]:
    """Per source: blocks and the slots it must fill."""
    out = []
    for i, ((source, size), goal) in enumerate(zip(size_of, target, strict=True)):
        blocks = -(-size // block)
        slots = min(round(goal / size * blocks), int(MAX_REPEAT) * blocks) if size else 0
        out.append({"sid": i, "source": source, "size": size, "target": goal,
                    "blocks": blocks, "slots": slots})
    return out


def draw_slots(spark, plan: list[dict], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, slot, sid, idx): the block that each slot of each output shard reads.

    Counts are drawn per shard from a generator seeded by the shard's number, so a
    task that is run again draws the same. Only per-shard counts cross the driver's
    plan as a window over shards; the slots themselves are made inside tasks.
    """
    total = sum(p["slots"] for p in plan)
    if not total:
        return spark.createDataFrame([], "shard long, slot long, sid int, idx long")
    prob = np.array([p["slots"] for p in plan], float) / total
    shards = -(-total // shard_slots)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            got = np.array([np.random.Generator(np.random.Philox(key=[seed, int(s)])).multinomial(
                min(shard_slots, total - s * shard_slots), prob) for s in ids]).reshape(len(ids), len(prob))
            k = len(prob)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(ids))),
                 pa.array(got.ravel().astype(np.int64))], ["shard", "sid", "n"])

    drawn = staged(spark.range(shards).mapInArrow(counts, "shard long, sid int, n long"), "mix-counts")
    table = spark.createDataFrame([(p["sid"], p["slots"], p["blocks"]) for p in plan],
                                  "sid int, quota long, blocks long")
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_shard = Window.partitionBy("shard").orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (drawn.withColumn("upto", F.sum("n").over(before))
            .withColumn("slot0", F.sum("n").over(in_shard) - F.col("n"))
            .join(F.broadcast(table), "sid")  # one row per source, made from the driver's list
            .withColumn("j0", F.col("upto") - F.col("n")))
    # draws beyond the quota, numbered, become the slots that other sources still miss
    got = {r["sid"]: r["s"] for r in drawn.groupBy("sid").agg(F.sum("n").alias("s")).collect()}
    over, short, at = [], [], 0
    for p in plan:
        extra = got.get(p["sid"], 0) - p["slots"]
        if extra > 0:
            over.append((p["sid"], at))
            at += extra
    at = 0
    for p in plan:
        miss = p["slots"] - got.get(p["sid"], 0)
        if miss > 0:
            short.append((p["sid"], at, at + miss, got.get(p["sid"], 0)))
            at += miss
    # few small rows that grow by shard_slots / sources each: spread them before they do
    spread = max(spark.sparkContext.defaultParallelism, shards // 16)
    slots = runs.filter("n > 0").repartition(spread, "shard", "sid").select(
        "shard", "slot0", "sid", "quota", "blocks", "j0",
        F.posexplode(F.sequence("j0", F.col("j0") + F.col("n") - 1)).alias("k", "j"))
    slots = slots.select("shard", (F.col("slot0") + F.col("k")).alias("slot"), "sid", "quota", "blocks", "j")
    keep = slots.filter("j < quota").select("shard", "slot", "sid", "blocks", "j")
    if short:
        o = spark.createDataFrame(over, "sid int, first long")
        m = spark.createDataFrame(short, "nsid int, lo long, hi long, have long")
        moved = (slots.filter("j >= quota").join(F.broadcast(o), "sid")
                 .select("shard", "slot", (F.col("j") - F.col("quota") + F.col("first")).alias("e"))
                 .join(F.broadcast(m), (F.col("e") >= F.col("lo")) & (F.col("e") < F.col("hi")))
                 .select("shard", "slot", F.col("nsid").alias("sid"), (F.col("have") + F.col("e") - F.col("lo")).alias("j"))
                 .join(F.broadcast(table), "sid").select("shard", "slot", "sid", "blocks", "j"))
        keep = keep.unionByName(moved)
    return keep.select("shard", "slot", "sid", "blocks", "j").mapInArrow(
        block_indices, "shard long, slot long, sid int, idx long")


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with sizes and sid, slots, pieces).

    ``pieces`` has, for each block of a source, the documents it is made of:
    (sid, idx, doc_id, rid, copy, first word in the document, words).
    """
    spark = docs.sparkSession
    laid = staged(sized(docs), "mix-laid")
    rows = laid.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row per source
    rows = sorted(((r["source"], int(r["n"])) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([n for _, n in rows])
    plan = quotas(rows, block, goal)
    table = spark.createDataFrame([(p["sid"], p["source"], p["size"], p["target"]) for p in plan],
                                  "sid int, src string, source_size long, target double")
    laid = laid.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    slots = draw_slots(spark, plan, shard_slots)
    first, end = F.col("idx") * block, F.col("start") + F.col("size")
    pieces = laid.filter("size > 0").select(
        "sid", "doc_id", "rid", "copy", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("idx"))
    lo, hi = F.greatest(first, F.col("start")), F.least(first + block, end)
    pieces = pieces.select("sid", "idx", "doc_id", "rid", "copy",
                           (lo - F.col("start")).alias("first"), (hi - lo).alias("words"))
    return laid, slots, pieces


def taken_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    laid, slots, pieces = mix(docs, block)
    use = slots.groupBy("sid", "idx").agg(F.count(F.lit(1)).alias("times"))
    took = (pieces.join(use, ["sid", "idx"])
            .groupBy("doc_id", "rid", "copy", "sid").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    took = took.select(F.col("doc_id").alias("d2"), F.col("rid").alias("r2"), F.col("copy").alias("c2"),
                       F.col("sid").alias("s2"), "taken")
    same = (F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("rid") == F.col("r2"))
            & (F.col("copy") == F.col("c2")) & (F.col("sid") == F.col("s2")))
    return laid.join(took, same, "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_blocks(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: (shard, slot, source, part, doc_id, words) with the words of each piece.

    Shard files can be written with ``partitionBy('shard')``; a slot's pieces in
    order of ``part`` are its block of tokens.
    """
    laid, slots, pieces = mix(docs, block, shard_slots)
    text = docs.select(F.xxhash64("doc_id", "text").alias("r3"), "text").dropDuplicates(["r3"])
    held = F.slice(words(F.col("text")), (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    named = laid.select("sid", "source").distinct()
    cut = pieces.join(text, F.col("rid") == F.col("r3")).select(
        "sid", "idx", "doc_id", "first", held.alias("tokens"))
    return (slots.join(cut, ["sid", "idx"]).join(F.broadcast(named), "sid")
            .select("shard", "slot", "source", "doc_id", "first", "tokens"))
