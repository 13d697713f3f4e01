"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two aggregations and joins over the remaining edges and is written to the
shared checkpoint folder, so lineage stays short and no link reaches the driver (only a
count and a checksum per round do).

Defined cases: repeated links, links of a node with itself and links with a null end add nothing;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (u, v), bigint; root is the smallest node reachable."""
    edges = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = None
    while True:
        edges = staged(_small_star(_large_star(edges)).distinct() if mark else edges, "star-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == tuple(now) or now[0] == 0:
            break
        mark = tuple(now)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
