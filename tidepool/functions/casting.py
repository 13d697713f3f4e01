"""Permissive re-parsing of text columns into a typed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each column named in ``schema`` with ``try_cast``.

    A cell that does not parse becomes NULL and its row is kept, as the CSV
    reader does in PERMISSIVE mode. Columns not in ``schema`` pass through.
    Decimal casts round half up; overflow gives NULL.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c)
        for c in df.columns
    ])
