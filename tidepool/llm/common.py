"""Helpers shared by the operators: written intermediate tables, folds, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import work_path

SLICE_BYTES = 4 << 20  # text that a Python task holds at once
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives lost executors and is not computed twice.
    """
    path = work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_fold(column: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % F.lit(folds)


def lower_ascii(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def stretches(text: Column, seed: Column, most: int, piece: int) -> Column:
    """The text, or stretches of ``piece`` characters of a longer one that a hash picks from the whole of
    it, ``most`` characters in all, in order."""
    several = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / piece).cast("int"))
    ranked = F.sort_array(F.transform(several, lambda i: F.struct(F.xxhash64(seed, i).alias("h"), i.alias("i"))))
    picked = F.sort_array(F.transform(F.slice(ranked, 1, most // piece), lambda x: x["i"]))
    cut = F.array_join(F.transform(picked, lambda i: F.substring(text, i * piece + 1, F.lit(piece))), " ")
    return F.when(F.length(text) <= most, text).otherwise(cut)


def slices(rows: pa.StructArray, text: int, most: int = SLICE_BYTES) -> Iterator[pa.StructArray]:
    """The rows in parts of about ``most`` bytes of their text field (a longer text alone)."""
    sizes = pc.fill_null(pc.binary_length(rows.field(text)), 0).to_numpy()
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield rows.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < len(rows):
        yield rows.slice(first)


def arrow_columns(df: DataFrame, text: str, new: T.StructType,
                  make: Callable[[], Callable[[list], dict]]) -> DataFrame:
    """Add computed columns to every row by Arrow batches.

    ``make()`` runs once per task and returns ``fn(texts) -> {column: values}``.
    The whole input row travels untouched in one struct column, so extra columns
    of any name cannot clash; the result has columns ``row`` and those of ``new``.
    """
    schema = T.StructType([T.StructField("row", df.schema), *new.fields])
    names, at = [f.name for f in new.fields], df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            for part in slices(batch.column(0), at):
                fn = fn or make()
                got = fn(part.field(at).to_pylist())
                yield pa.RecordBatch.from_arrays([part, *(pa.array(got[n]) for n in names)], ["row", *names])

    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).mapInArrow(run, schema)


def time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Layout of sequences step by step: (order by falling length, active sequences per
    step, offset of each step). Step t of the d-th longest sequence lies at offset[t] + d."""
    order = np.argsort(-lengths, kind="stable")
    active = len(lengths) - np.cumsum(np.bincount(lengths))[:-1] if len(lengths) else np.empty(0, int)
    return order, active, np.concatenate([[0], np.cumsum(active)]).astype(np.int64)


def word_groups(lengths: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Indices of sequences, longest first, in groups of about ``most`` steps."""
    order = np.argsort(-lengths, kind="stable")
    group = np.cumsum(lengths[order]) // most
    for cut in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(cut):
            yield cut
