"""Suffix-array dedup: remove every byte covered by a ``SPAN``-byte string that starts twice.

Sharding. Each window of ``SPAN`` bytes belongs to the smallest hash among its ``GRAM``-byte
grams (leftmost of equals). Equal windows have equal smallest grams, so grouping by that hash
brings equal windows together; neighbouring windows with the same gram form one piece of at
most 2 * SPAN bytes. A text over ``BLOCK_BYTES`` is cut in stretches that overlap by SPAN - 1
bytes, of any length in all. Only grams that occur in two pieces or more go on. Equal pieces are
represented once, with their number of occurrences, so a group of copies of any size costs one.

Sorting. Every shard sorts its pieces' suffixes by external induced sorting (``induced.py``),
which carries common prefixes along; a run of neighbours that share ``SPAN`` bytes and stand
for two starts or more is repeated. Shards hold about ``SHARD_BYTES``; a task reads its shard in
order of grams and sorts whole grams, about ``SORT_BYTES`` at once (equal windows have equal grams),
so its memory does not grow with what its shard was dealt. A gram with over ``HOT_PIECES`` different pieces is split: its pieces are cut where the gram's offset in the
window enters another part of ``STEPS[0]`` offsets. All windows of such a cut share a core,
the bytes that any window of the part has around the gram, and equal windows have equal cores:
so cuts meet by core, equal cuts are represented once, and a core that still has over
``HOT_PIECES`` different cuts is split by the next, smaller step. With one offset a part the
core is the whole window, so no group is larger than ``HOT_PIECES``.

Removal. The repeated ranges go back to all occurrences of a piece, then to their documents,
where the bytes they cover are dropped.

Texts travel twice: all of them once to be cut, those with repeated grams once more to be
hashed. Equal pieces are told by 128 bits of two hashes over one piece length.

Defined cases: a null text is empty; texts under ``SPAN`` bytes keep everything; equal rows
count as separate documents (and so repeat each other); rows are told by id and a hash of
the text, so null or repeated ids work; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import staged
from tidepool.llm.induced import Store, repeated

SPAN, GRAM, SHARD_BYTES = 200, 32, 4 << 20
SORT_BYTES = 1 << 19  # sorted at once; sorting holds about 75 times its bytes
CUT_BYTES = 1 << 18  # cut at once (a longer stretch alone), so that the arrays of 64-bit hashes stay in a core's cache
HOT_PIECES = 5_000  # different pieces of one gram, or cuts with one core, beyond which they are split
STEPS = (29, 5, 1)  # offsets of a part: 169 offsets make 6, then 34, then 169 parts
BLOCK_BYTES, POSITION_BITS = 1 << 20, 24
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Powers:
    """Powers of the hash base and its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * BLOCK_BYTES)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE)]), dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def pieces(texts: list[bytes], powers: Powers, span: int = SPAN, gram: int = GRAM):
    """(gram hash, piece hash, windows, gram's offset in the first window, document index, first
    window start) of every piece of the texts, as arrays."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    if n > 1 << POSITION_BITS:
        raise ValueError(f"{n} bytes at once; positions have {POSITION_BITS} bits")
    if n < span:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    powers.reach(n + 1)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:n], dtype=np.uint64)])
    grams = mixed((prefix[gram:] - prefix[:-gram]) * powers.down[: n - gram + 1])
    # least (hash, position) over the grams of each window; the position fills the low bits
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    wide, width = span - gram + 1, 1
    while 2 * width <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: n - span + 1], least[wide - width:][: n - span + 1])
    ends = np.cumsum(sizes)
    start = np.arange(n - span + 1)
    doc = np.repeat(np.arange(len(texts)), sizes)[: n - span + 1]
    inside = np.flatnonzero(start + span <= ends[doc])
    if not len(inside):
        return pieces([], powers, span, gram)
    at, owner = (least[inside] & low).astype(np.int64), doc[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(inside)))
    lo = inside[first]
    whole = mixed((prefix[lo + windows + span - 1] - prefix[lo]) * powers.down[lo] + np.uint64(0xD6E8FEB86659FD93))
    return grams[at[first]], whole, windows, at[first] - lo, owner[first], lo - (ends - sizes)[owner[first]]


def stretches(texts: list[bytes], span: int = SPAN, most: int = BLOCK_BYTES) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The texts, longer ones cut into stretches of ``most`` bytes that overlap by ``span`` - 1, so that
    each window lies in one of them: (stretches, text index and first byte of each)."""
    cuts = [(i, a) for i, t in enumerate(texts) for a in range(0, max(1, len(t) - span + 1), most - span + 1)]
    index, base = np.array(cuts, np.int64).reshape(-1, 2).T
    return [texts[i][a:a + most] for i, a in cuts], index, base


def blocks(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes in all (a longer text alone)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


OCCURRENCE = "gram long, piece long, windows int, offset int, doc_id {kind}, th long, start int"


def occurrences(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per piece of every text."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts, index, base = stretches([raw(t) for t in batch.column(2).to_pylist()], span)
            for a, b in blocks(texts, CUT_BYTES):
                gram, piece, windows, offset, owner, start = pieces(texts[a:b], powers, span)
                take, start = pa.array(index[owner + a]), start + base[owner + a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(piece.view(np.int64)), pa.array(windows.astype(np.int32)),
                     pa.array(offset.astype(np.int32)), batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(start.astype(np.int32))], ["gram", "piece", "windows", "offset", "doc_id", "th", "start"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, OCCURRENCE.format(kind=kind.simpleString()))


PIECE = "gram long, piece long, windows int, times long, offset int, bytes binary"


def cut_pieces(per_doc: DataFrame, span: int) -> DataFrame:
    """The bytes of the representatives: (gram, piece, windows, times, offset, bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text, reps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = raw(text)
                for r in reps or ():
                    for column, value in zip(out, (r["gram"], r["piece"], r["windows"], r["times"], r["offset"],
                                                   data[r["start"]:r["start"] + r["windows"] + span - 1]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.int32()), pa.array(out[5], pa.binary())],
                ["gram", "piece", "windows", "times", "offset", "bytes"])

    return per_doc.select("text", "reps").mapInArrow(run, PIECE)


def hashed(*parts: bytes) -> int:
    h = hashlib.blake2b(digest_size=8)
    for p in parts:
        h.update(p)
    return int.from_bytes(h.digest(), "little", signed=True)


def cuts_of(offset: int, windows: int, data: bytes, step: int, span: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, windows, hash of the core, hash of the cut) of a piece's cuts into parts of ``step``
    offsets; window i has the gram at offset - i."""
    part = (offset - np.arange(windows)) // step
    edge = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), windows]
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        low = int(part[a]) * step
        tag = b"%d %d " % (step, low)
        core = hashed(tag, data[offset - low:offset - low - step + 1 + span])
        yield a, b - a, core, hashed(tag, b"%d " % (offset - a), data[a:b + span - 1])


def cut_hot(rows: DataFrame, step: int, span: int) -> DataFrame:
    """Pieces (``PIECE``) cut: (g0, p0, first) name the piece and the cut's first window in it, the cut is
    a piece again, whose ``gram`` is the hash of its core."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for g, p, windows, times, offset, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a, n, core, same in cuts_of(offset, windows, data, step, span):
                    for column, value in zip(out, (g, p, a, core, same, n, times, offset - a, data[a:a + n + span - 1]),
                                             strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["g0", "p0", "first", "gram", "piece", "windows", "times", "offset", "bytes"])

    return rows.select("gram", "piece", "windows", "times", "offset", "bytes").mapInArrow(
        run, f"g0 long, p0 long, first int, {PIECE}")


def hot_grams(rows: DataFrame, label: str) -> DataFrame:
    return staged(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_PIECES).select(
        F.col("gram").alias("hot_gram")), label)


def sorted_ranges(rows: DataFrame, total: int, span: int) -> DataFrame:
    """Repeated ranges (gram, piece, lo, hi) of pieces of ``total`` bytes, sorted in shards by gram."""
    shards = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // SHARD_BYTES))
    return (rows.repartition(shards, "gram").sortWithinPartitions("gram")
            .mapInArrow(sort_shard(span), "gram long, piece long, lo int, hi int"))


def hot_ranges(rows: DataFrame, span: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """Repeated ranges of the pieces of hot grams, by cuts."""
    cuts = staged(cut_hot(rows, steps[0], span), f"sa-cuts-{steps[0]}")
    reps = staged(cuts.groupBy("gram", "piece").agg(
        F.first("windows").alias("windows"), F.sum("times").alias("times"), F.first("offset").alias("offset"),
        F.first("bytes").alias("bytes")), f"sa-cut-pieces-{steps[0]}")
    hot = hot_grams(reps, f"sa-cut-hot-{steps[0]}") if steps[1:] else None
    if hot is None or hot.isEmpty():
        cold, more = reps, None
    else:
        cold = reps.join(hot, F.col("gram") == F.col("hot_gram"), "left_anti")
        more = hot_ranges(reps.join(hot, F.col("gram") == F.col("hot_gram"), "left_semi"), span, steps[1:])
    total = int(cold.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0])
    found = sorted_ranges(cold, total, span)
    found = (found.unionByName(more) if more is not None else found).select(
        F.col("gram").alias("g3"), F.col("piece").alias("p3"), "lo", "hi")
    return cuts.select("g0", "p0", "first", "gram", "piece").join(
        found, (F.col("gram") == F.col("g3")) & (F.col("piece") == F.col("p3"))).select(
        F.col("g0").alias("gram"), F.col("p0").alias("piece"), (F.col("first") + F.col("lo")).alias("lo"),
        (F.col("first") + F.col("hi")).alias("hi"))


def whole_grams(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Different rows (gram, piece, windows, times, bytes) of batches in order of grams, in lists of whole
    grams of about ``most`` bytes (a larger gram alone)."""
    ready, group, seen, sizes = [], [], set(), [0, 0]
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "piece", "windows", "times", "bytes")), strict=True):
            if group and group[0][0] != row[0]:
                ready.extend(group)
                group, seen, sizes = [], set(), [sum(sizes), 0]
            if row[1] in seen:  # equal rows of the input name the same representative
                continue
            if ready and sum(sizes) + len(row[4]) > most:
                yield ready
                ready, sizes = [], [0, sizes[1]]
            seen.add(row[1])
            group.append(row)
            sizes[1] += len(row[4])
    if ready or group:
        yield ready + group


def sort_shard(span: int):
    """A task's pieces, in order of grams, to their repeated ranges (gram, piece, lo, hi), window starts
    in the piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_grams(batches, SORT_BYTES):
            gram, piece, windows, times, data = zip(*rows, strict=True)
            out: list[list] = [[], [], [], []]
            for g, p, found in zip(gram, piece, repeated(data, windows, times, span, Store()), strict=True):
                for lo, hi in found:
                    for column, value in zip(out, (g, p, lo, hi), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.int32())], ["gram", "piece", "lo", "hi"])

    return run


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removals(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Documents with repeated strings: (doc_id, th, text, spans as byte ranges to remove)."""
    found = occurrences(docs, span)
    shared = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("gram").alias("g2"))
    alive = staged(found.join(shared, F.col("gram") == F.col("g2")).drop("g2"), "sa-occurrences")
    rep = staged(alive.groupBy("gram", "piece", "windows").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "th", "start", "offset")).alias("r")), "sa-pieces")
    hot = hot_grams(rep, "sa-hot")
    reps = (rep.join(hot, F.col("gram") == F.col("hot_gram"), "left")
            .select(F.col("r.doc_id").alias("doc_id"), F.col("r.th").alias("th"), F.struct(
                "gram", "piece", "windows", "times", F.col("r.start").alias("start"), F.col("r.offset").alias("offset"),
                F.col("hot_gram").isNotNull().alias("hot")).alias("rep")))
    # a document holds its own pieces at most, so the list is bounded by its text
    named = (reps.groupBy("doc_id", "th").agg(F.collect_list("rep").alias("reps"))
             .join(alive.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2")).distinct(),
                   F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")), "right")
             .select("d2", "t2", "reps"))
    per_doc = staged(docs.join(named, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")))
                     .select("doc_id", "th", "text", "reps"), "sa-texts")
    total = int(rep.agg(F.coalesce(F.sum(F.col("windows") + F.lit(span - 1)), F.lit(0))).first()[0])
    if hot.isEmpty():
        repeats = sorted_ranges(cut_pieces(per_doc, span), total, span)
    else:
        of = lambda heat: cut_pieces(per_doc.withColumn(
            "reps", F.filter("reps", lambda r: r["hot"] == F.lit(heat))), span)
        repeats = sorted_ranges(of(False), total, span).unionByName(hot_ranges(of(True), span))
    back = (alive.join(repeats.select(F.col("gram").alias("g3"), F.col("piece").alias("p3"), "lo", "hi"),
                       (F.col("gram") == F.col("g3")) & (F.col("piece") == F.col("p3")))
            .select("doc_id", "th", F.struct((F.col("start") + F.col("lo")).alias("a"),
                                             (F.col("start") + F.col("hi") + F.lit(span - 1)).alias("b")).alias("s")))
    spans = back.groupBy("doc_id", "th").agg(F.collect_set("s").alias("s")).select(
        F.col("doc_id").alias("d4"), F.col("th").alias("t4"), "s")
    return per_doc.select("doc_id", "th", "text").join(
        spans, F.col("doc_id").eqNullSafe(F.col("d4")) & (F.col("th") == F.col("t4"))).select("doc_id", "th", "text", "s")


def report(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("th"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, n_spans, sha = [], [], []
            for t, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data, spans, at, h = raw(t), merge([(x["a"], x["b"]) for x in s]), 0, hashlib.sha256()
                for a, b in spans:
                    h.update(data[at:a])
                    at = b
                h.update(data[at:])
                removed.append(sum(b - a for a, b in spans))
                n_spans.append(len(spans))
                sha.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha)],
                ["d5", "t5", "n_removed", "n_spans", "sha"])

    cut = removals(keyed, span).mapInArrow(
        run, f"d5 {kind}, t5 long, n_removed long, n_spans long, sha string").dropDuplicates(["d5", "t5"])
    every = docs.select("doc_id", F.xxhash64(text).alias("th"), F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text.cast("binary"), 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return every.join(cut, F.col("doc_id").eqNullSafe(F.col("d5")) & (F.col("th") == F.col("t5")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


def strip_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, th, pieces): the byte ranges that ``report`` removes, per document with any."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    return removals(keyed, span).select("doc_id", "th", F.col("s").alias("ranges"))
