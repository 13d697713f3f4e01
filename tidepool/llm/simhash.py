"""SimHash near-dedup with a byte-position inverted index and count filtering.

A 64-bit fingerprint has eight byte positions. Two fingerprints at ``max_bits`` = 3 or
fewer differing bits differ in at most three of them, so they share at least five
positional bytes: the guaranteed minimum. An index by single positional bytes has only
2048 lists, each a 256th of everything, and a tally over them grows with the square of
the input. The lists here are those of the 56 sets of five byte positions: a pair with
m shared bytes meets in C(m, 5) of them, so a pair meets if and only if its tally reaches
the minimum, and nothing below it is ever produced. In a list the pairs are verified by
their differing bits.

Only distinct fingerprints enter the index. A list's members agree in 40 bits, so it has
at most 2**24 of them, whatever the corpus. A list yields a spanning forest of its links,
never all pairs; larger lists look up the neighbours of a member instead of comparing all.

Defined cases: null and empty texts have no words and fingerprint zero (they link like any
other); fewer words than a shingle make one shingle; a bit set in exactly half of the hashes
is 0; texts of any length are read whole; equal rows share a fingerprint; rows
with a null id take part, and ``component_id`` is the smallest non-null id (null if a
component has none); empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import arrow_columns, staged
from tidepool.llm.components import components

SHINGLE, MAX_BITS, HASH_SEED = 3, 3, 42
ALL_PAIRS = 4096  # lists up to this size are compared whole, larger ones by neighbour lookup


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and ASCII white space only
    if not words:
        return 0
    flat, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], HASH_SEED) for a, b in zip(starts, ends[k - 1:].tolist(), strict=True)], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``row`` and ``fp``: the fingerprint as a signed 64-bit number."""
    def make():
        return lambda texts: {"fp": np.array([fingerprint(t, shingle) for t in texts], "<u8").view("<i8")}

    return arrow_columns(docs, "text", T.StructType([T.StructField("fp", T.LongType())]), make)


def position_sets(max_bits: int = MAX_BITS) -> list[int]:
    """Signed masks of all sets of 8 - max_bits byte positions."""
    out = []
    for kept in combinations(range(8), 8 - max_bits):
        mask = sum(0xFF << (8 * p) for p in kept)
        out.append(mask - 2**64 if mask >= 2**63 else mask)
    return out


def spanning_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list[int], list[int]]:
    """Index pairs that connect all members of one list linked at ``max_bits`` or fewer."""
    left, right = [], []
    if len(fps) <= ALL_PAIRS:
        rest = np.arange(len(fps))
        while len(rest):
            todo, rest = [int(rest[0])], rest[1:]
            while todo and len(rest):
                at = todo.pop()
                near = np.bitwise_count(fps[rest] ^ fps[at]) <= max_bits
                found = rest[near].tolist()
                left += [at] * len(found)
                right += found
                todo += found
                rest = rest[~near]
        return left, right
    order = np.argsort(fps)
    ranked, seen = fps[order], np.zeros(len(fps), bool)
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [1 << b for b in range(64) if free >> b & 1]
    balls = np.array([sum(c) for k in range(1, max_bits + 1) for c in combinations(bits, k)], np.uint64)
    for first in range(len(ranked)):
        if seen[first]:
            continue
        seen[first], todo = True, [first]
        while todo:
            at = todo.pop()
            want = ranked[at] ^ balls
            where = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
            found = np.unique(where[(ranked[where] == want) & ~seen[where]])
            seen[found] = True
            left += [int(order[at])] * len(found)
            right += order[found].tolist()
            todo += found.tolist()
    return left, right


def list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key to links (u, v). Holds one list at a time."""
    keep_key, keep_fp = np.empty(0, np.int64), np.empty(0, np.int64)

    def emit(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def lists(key, fp):
        cut = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            members = np.unique(fp[a:b])
            left, right = spanning_links(members.view(np.uint64))
            if left:
                yield emit(members[left], members[right])

    for batch in batches:
        key = np.concatenate([keep_key, batch.column(0).to_numpy()])
        fp = np.concatenate([keep_fp, batch.column(1).to_numpy()])
        last = np.searchsorted(key, key[-1]) if len(key) else 0
        yield from lists(key[:last], fp[:last]) if last else ()
        keep_key, keep_fp = key[last:], fp[last:]
    if len(keep_key):
        yield from lists(keep_key, keep_fp)


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect exactly what links at max_bits connect."""
    masks = position_sets(max_bits)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])
    return (distinct_fps.select("fp", F.explode(keys).alias("key")).select("key", "fp")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(list_links, "u long, v long").distinct())


def near_duplicates(ids: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``ids`` (doc_id, fp)."""
    reps = staged(ids.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    label = components(links(reps.select("fp"), max_bits))
    linked = staged(reps.join(label, F.col("fp") == F.col("node")).select("fp", "rep", "root"), "simhash-linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(least, "root").select(F.col("fp").alias("fp2"), "component_id")
    return reps.join(named, F.col("fp") == F.col("fp2"), "left").select(
        "fp", F.coalesce("component_id", "rep").alias("component_id"))


def report(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    ids = staged(fingerprints(docs.select("doc_id", "text"), shingle)
                 .select("row.doc_id", "fp"), "simhash-ids")
    group = near_duplicates(ids, max_bits).withColumnRenamed("fp", "fp3")
    return ids.join(group, F.col("fp") == F.col("fp3")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents less their near copies: of each component the row with the smallest id stays
    (one of them, if equal rows share it). A component without any id keeps one row per fingerprint."""
    marked = staged(fingerprints(docs, shingle), "simhash-rows")
    ids = marked.select(F.col("row.doc_id").alias("doc_id"), "fp")
    group = near_duplicates(ids, max_bits).withColumnRenamed("fp", "fp3")
    # only rows whose id is the smallest of their component go on, so copies never meet in one task
    firsts = marked.join(group, (F.col("fp") == F.col("fp3"))
                         & F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    numbered = firsts.withColumn("_copy", F.row_number().over(
        Window.partitionBy("component_id", F.coalesce("component_id", "fp")).orderBy("fp")))
    return numbered.filter("_copy = 1").select("row.*")
