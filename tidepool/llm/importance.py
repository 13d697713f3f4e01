"""Importance resampling towards a target distribution, and an exact parallel ranking.

Features (runs of words) are hashed into buckets; a bucket's gain is the floored log ratio of its
share in the target texts to its share in the corpus. Documents are scored array by array: the
features of a batch are one array of buckets, their gains one lookup. A document's weight is its mean
gain; with Gumbel noise from a hash of its id, the highest scores are a draw without replacement in
proportion to exp(weight / 1000).

Ranks come from sorting by regular sampling. The scored rows are sorted run by run (a run is a
partition); every run gives keys at regular positions; every ``runs``-th of all those keys, sorted, is a
splitter; each run is cut at the splitters, equal pieces go to one segment, where they are merged;
the number of rows in the segments before it is added to a row's place in its segment. Keys end
with the run and the place in it, so they are unique and no segment holds more than twice its share,
whatever repeats. Segments that begin beyond the last rank are neither sent nor merged.

Bounds: the corpus counts are ``buckets`` numbers; at most ``SEGMENTS`` runs, so ``SEGMENTS`` squared keys
are sorted in one task and ``SEGMENTS`` splitters and counts reach the driver, at any size.

Defined cases: a null or empty text has no features and weight 0; a null id is hashed as empty text
and comes after other ids in ties; equal rows get different ranks, in any order (their other columns
agree); texts are read whole, a batch of ``SLICE_BYTES`` at a time; without target texts the gains
compare with an even distribution; an empty table gives an empty result; extra columns of any name
travel along in ``row``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import slices, staged

# Words of the lowered text (bytes above 127 belong to other scripts' letters), the seed.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BUCKETS, ORDERS, SEED = 10_000, 1, "2024"
LEAST_WORDS, PERCENT = 20, 10

SEGMENT_ROWS, SEGMENTS = 50_000, 2_000
KNOWN_WORDS = 200_000   # buckets of words that a task remembers
ROW_BITS = 33           # bits of monotonically_increasing_id() that hold the row's place in its partition


class Featurizer:
    """Texts -> buckets of all runs of 1 to ``orders`` words, as one array, and features per text."""

    def __init__(self, buckets: int, orders: int):
        self.buckets, self.orders, self.known = buckets, orders, {}

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known, n, out, sizes, words = self.known, self.buckets, [], [], []
        for text in texts:
            w = WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
            words.append(len(w))
            grams = w if self.orders == 1 else [
                b" ".join(w[i:i + k]) for k in range(1, self.orders + 1) for i in range(len(w) - k + 1)]
            for g in grams:
                b = known.get(g)
                if b is None:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    b = known[g] = zlib.crc32(g) % n
                out.append(b)
            sizes.append(len(grams))
        return np.array(out, np.int64), np.array(sizes, np.int64), np.array(words, np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> np.ndarray:
    """Features in each bucket over all rows of ``texts`` (text); one row a bucket and task is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Featurizer(buckets, orders), np.zeros(buckets, np.int64)
        for batch in batches:
            rows = pa.StructArray.from_arrays(batch.columns, batch.schema.names)
            for part in slices(rows, 0):
                total += np.bincount(features(part.field(0).to_pylist())[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():   # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+n) / ((s+1)(T+n)))) of each of n buckets, in doubles."""
    n, S, T_ = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (S + n) / ((s + 1) * (T_ + n))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, carry: list[str], orders: int = ORDERS) -> DataFrame:
    """``row`` (the columns ``carry``), ``n_words``, ``n_features`` and ``weight`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)     # as many numbers as buckets
    kept = T.StructType([docs.schema[c] for c in carry])
    schema = T.StructType([T.StructField("row", kept), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        features = Featurizer(len(table), orders)
        for batch in batches:
            rows = pa.StructArray.from_arrays([batch.column(1), batch.column(0)], ["t", "row"])
            for part in slices(rows, 0):
                found, sizes, words = features(part.field(0).to_pylist())
                total = np.concatenate([[0], np.cumsum(table[found])])
                ends = np.cumsum(sizes)
                sums = total[ends] - total[ends - sizes]
                weight = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.field(1), pa.array(words), pa.array(sizes), pa.array(weight)], schema.names)

    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    return docs.select(row, F.col("text").alias("t")).mapInArrow(score, schema)


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(seed:id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, most: int | Column, total: int) -> DataFrame:
    """``rows`` (``total`` of them, with ``score`` and ``row.doc_id``) and ``rank``: 1, 2, … for the ``most``
    highest scores, ties to smaller ids, null for the rest; by regular sampling."""
    spark = rows.sparkSession
    p = max(1, min(SEGMENTS, -(-total // SEGMENT_ROWS)))
    order = [F.desc("score"), F.asc_nulls_last("row.doc_id")]
    place = F.monotonically_increasing_id()
    runs = staged(rows.coalesce(p).sortWithinPartitions(*order).withColumn("_run", F.shiftright(place, ROW_BITS))
                  .withColumn("_at", place.bitwiseAND(F.lit((1 << ROW_BITS) - 1))), "importance-runs")
    key = [F.col("score").alias("score"), F.col("row.doc_id").cast("long").alias("id"), F.col("_run").alias("run"), F.col("_at").alias("at")]
    sizes = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / p))
    regular = runs.join(F.broadcast(sizes), "_run").filter(F.col("_at") % step == 0).select(*key)   # p a run, at most 2p - 1
    each = Window.orderBy(F.desc("score"), F.asc_nulls_last("id"), "run", "at")    # at most 2 SEGMENTS**2 rows
    numbered = regular.withColumn("i", F.row_number().over(each)).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy()))
    every = F.floor((F.col("m") + p - 1) / p)
    splitters = [tuple(r) for r in numbered.filter(((F.col("i") - 1) % every == 0) & (F.col("i") > 1))
                 .orderBy("i").select("score", "id", "run", "at").collect()]

    tagged = staged(cut(runs, splitters), "importance-segments")
    counts = dict(tagged.groupBy("_segment").count().collect())
    before = np.concatenate([[0], np.cumsum([counts.get(g, 0) for g in range(len(splitters) + 1)])]).tolist()
    drawn_from = sum(b < most for b in before[:-1])     # segments 0 … drawn_from - 1 hold all ranks
    sent = tagged.filter(F.col("_segment") < drawn_from)
    merged = Window.partitionBy("_segment").orderBy(*order, "_run", "_at")
    rank = F.lit(before)[F.col("_segment")] + F.row_number().over(merged)
    none = F.lit(None).cast("long")
    out = sent.withColumn("rank", rank.cast("long")).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")).otherwise(none))
    rest = tagged.filter(F.col("_segment") >= drawn_from).withColumn("rank", none)
    return out.unionByName(rest).select(*rows.columns, "rank")


def cut(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Sorted runs with ``_segment``: the number of splitters at or before each row."""
    edge = np.array([(-s, i is None, i or 0, r, a, 0) for s, i, r, a in splitters], np.int64).reshape(-1, 6)
    shared = runs.sparkSession.sparkContext.broadcast(edge)     # SEGMENTS rows at most
    columns = [*runs.columns, "_segment"]
    schema = T.StructType([*runs.schema.fields, T.StructField("_segment", T.LongType())])
    frame = runs.select(F.struct(*runs.columns).alias("all"), F.col("row.doc_id").cast("long").alias("id"))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = shared.value
        for batch in batches:
            all_, id_ = batch.column(0), batch.column(1)
            number = lambda name: all_.field(name).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.stack([-number("score"), id_.is_null().to_numpy(zero_copy_only=False), id_.fill_null(0).to_numpy(),
                             number("_run"), number("_at"), np.ones(len(batch))], 1).astype(np.int64)
            both = np.concatenate([edges, rows])
            place = np.lexsort(both.T[::-1])
            before = np.cumsum(place < len(edges))      # splitters so far, in key order
            segment = np.empty(len(both), np.int64)
            segment[place] = before
            yield pa.RecordBatch.from_arrays(
                [*[all_.field(c) for c in columns[:-1]], pa.array(segment[len(edges):])], columns)

    return frame.mapInArrow(tag, schema)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             carry: list[str] | None = None, buckets: int = BUCKETS, orders: int = ORDERS, seed: str = SEED) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, all by default), ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` of every document; ``percent`` of those with ``least_words`` words are drawn."""
    carry = docs.columns if carry is None else carry
    gain = gains(bucket_counts(docs, buckets, orders), bucket_counts(target, buckets, orders))
    found = weigh(docs, gain, carry, orders).withColumn("score", F.col("weight") + gumbel(F.col("row.doc_id"), seed))
    found = staged(found, "importance-weights")
    may = F.col("n_words") >= least_words
    total = found.filter(may).count()
    drawn = ranked(found.filter(may), total * percent // 100, total)
    return drawn.unionByName(found.filter(~may).withColumn("rank", F.lit(None).cast("long")))


def sample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The documents drawn, with the columns of ``docs``."""
    return resample(docs, target, **settings).filter("rank IS NOT NULL").select("row.*")
