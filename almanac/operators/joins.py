"""Joins of a large fact table with a catalog-like lookup table.

A lookup that was proven small is broadcast. Any other is left to Spark, which broadcasts by its own
size estimate and else shuffles and splits the partitions of hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure the lookup: one row of partial sums per task, whatever its size. This runs a job, so
    plans measure once and hand the outcome to the operators."""
    width = F.lit(0)
    for field in lookup.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            as_text = F.to_json(F.struct(field.name))
            width = width + F.octet_length(as_text)
        else:
            width = width + 8
    rows, size = lookup.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(fact: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                small: bool = False) -> DataFrame:
    """Inner or left-semi join of ``fact`` to ``lookup``; ``small`` says that it was measured to fit
    a broadcast. The rows are the same either way."""
    return fact.join(F.broadcast(lookup) if small else lookup, key, how)
