"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking.

Vectors are scaled to length 1, where the largest cosine is the smallest Euclidean distance,
and hashed by ``TABLES`` tables of ``HASHES`` functions floor((a.x + b) / width) with normal
``a``. A query visits its own bucket and then the perturbed ones (steps of +-1 in some hash
values) in order of estimated success: the distances of its projections to the cell bounds
are sorted, and sets of them are visited by rising expected squared distance. The candidates
of all tables are merged and reranked by the exact cosine in double precision.

The search is a stated query set against all rows in blocks: rows fall by hash into blocks
of about ``BLOCK``, queries into blocks of ``QUERY_BLOCK``; a task holds one block of each,
builds that block's tables and returns at most ``k`` rows per query. Blocks are bounded, so
a vector that is repeated any number of times spreads over them. A query that finds fewer
than ``k`` candidates in a block scans that block, so nothing is lost where buckets are thin.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows without id; a row with the query's id is never its neighbour; equal
scores rank by smaller id; vectors of another dimension than the query's are not compared;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import staged

TABLES, HASHES, WIDTH, PROBES = 12, 4, 1.0, 40
BLOCK, QUERY_BLOCK, SEED = 4096, 1024, 97


def probe_sets(hashes: int, probes: int) -> np.ndarray:
    """Perturbation sets by rising expected cost, as rows of flags over the 2 * hashes bound
    distances in sorted order. Position j and its mirror belong to one hash function and never
    go together. The expected squared distance of the j-th is that of uniform order statistics."""
    n = 2 * hashes
    cost = [j * (j + 1) / (4 * (hashes + 1) * (hashes + 2)) if j <= hashes else
            1 - (n + 1 - j) / (hashes + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (hashes + 1) * (hashes + 2))
            for j in range(1, n + 1)]
    out, heap = [np.zeros(n, bool)], [(cost[0], (0,))]
    while heap and len(out) <= probes:
        total, s = heapq.heappop(heap)
        if not any(n - 1 - j in s for j in s):
            flags = np.zeros(n, bool)
            flags[list(s)] = True
            out.append(flags)
        if (j := s[-1]) + 1 < n:
            heapq.heappush(heap, (total - cost[j] + cost[j + 1], (*s[:-1], j + 1)))
            heapq.heappush(heap, (total + cost[j + 1], (*s, j + 1)))
    return np.array(out)


def candidates(rows: np.ndarray, queries: np.ndarray, tables: int, hashes: int, width: float, probes: int) -> np.ndarray:
    """(queries, rows) flags: which rows of unit length are met in a visited bucket."""
    met = np.zeros((len(queries), len(rows)), bool)
    sets = probe_sets(hashes, probes)
    for table in range(tables):
        rng = np.random.default_rng([SEED, table, rows.shape[1]])
        a, b = rng.normal(size=(rows.shape[1], hashes)), rng.uniform(0, width, hashes)
        mix = rng.integers(1, 2**62, hashes, dtype=np.int64) | 1
        key = (np.floor((rows @ a + b) / width).astype(np.int64) * mix).sum(axis=1)
        order = np.argsort(key, kind="stable")
        key = key[order]
        cell = (queries @ a + b) / width
        low = cell - np.floor(cell)
        far = np.concatenate([low, 1 - low], axis=1)  # to the lower bound (step -1), to the upper (step +1)
        step = np.concatenate([-mix, mix])[np.argsort(far, axis=1)]
        visit = (np.floor(cell).astype(np.int64) * mix).sum(axis=1)[:, None] + step @ sets.T.astype(np.int64)
        first, last = np.searchsorted(key, visit, "left"), np.searchsorted(key, visit, "right")
        for q in range(len(queries)):
            full = np.flatnonzero(last[q] > first[q])
            for x, y in zip(first[q, full].tolist(), last[q, full].tolist(), strict=True):
                met[q, order[x:y]] = True
    return met


def search_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, **how):
    """(query id, row id, cosine) of the best ``k`` candidates of every query in one block."""
    out: tuple[list, list, list] = ([], [], [])
    norm, query_norm = (np.sqrt((x * x).sum(axis=1)) for x in (rows, queries))
    met = candidates(rows / norm[:, None], queries / query_norm[:, None], **how)
    for q, own in enumerate(query_ids.tolist()):
        met[q] &= ids != own
        near = np.flatnonzero(met[q])
        if len(near) < k:
            near = np.flatnonzero(ids != own)
        score = (rows[near] * queries[q]).sum(axis=1) / (norm[near] * query_norm[q])
        best = near_best = np.lexsort((ids[near], -score))[:k]
        for column, values in zip(out, ([own] * len(best), ids[near][near_best].tolist(), score[best].tolist()), strict=True):
            column += values
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
            .filter("id is not null and v is not null").filter(whole & F.exists("v", lambda x: x != 0)))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES, hashes: int = HASHES,
           width: float = WIDTH, probes: int = PROBES, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every query."""
    rows = staged(usable(vectors), "ann-rows")
    asked = staged(usable(queries).dropDuplicates(["id"]), "ann-queries")
    n_rows, n_asked = max(1, -(-rows.count() // block)), max(1, -(-asked.count() // query_block))
    part = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n))
    cells = (rows.select("id", "v", F.lit(False).alias("asks"), part(n_rows).alias("r"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("q"))
             .unionByName(asked.select("id", "v", F.lit(True).alias("asks"), part(n_asked).alias("q"),
                                       F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("r"))))
    how = {"tables": tables, "hashes": hashes, "width": width, "probes": probes}

    def run(table: pa.Table) -> pa.Table:
        ids, asks = table["id"].to_numpy(), table["asks"].to_numpy()
        v = table["v"].combine_chunks()
        size, flat = pc.list_value_length(v).to_numpy(), v.flatten().to_numpy()
        at = np.cumsum(size) - size
        found: tuple[list, list, list] = ([], [], [])
        for dim in np.unique(size[asks]):
            take = lambda who: flat[at[(size == dim) & who][:, None] + np.arange(dim)]  # noqa: B023,E731
            pick = ids[(size == dim) & ~asks]
            if len(pick):
                for column, values in zip(found, search_block(
                        pick, take(~asks), ids[(size == dim) & asks], take(asks), k, **how), strict=True):
                    column += values
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    near = cells.groupBy("r", "q").applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
