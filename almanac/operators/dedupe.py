"""Keep the first or last row of every key, by explicit arrival order.

Written as ``row_number() = 1``, for which Spark puts a group limit below the exchange: each
task ships at most one row per key, so a key with very many copies costs no large shuffle. The
window partitions by a hash of the keys and the keys themselves: a sort that leads with a number
decides nearly every comparison on its 8-byte prefix, where string keys would be read in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_hash(keys: list[str]) -> Column:
    """A number for the keys in whose order rows of one first key are neighbours, as they compress
    better when shuffled and written."""
    first = F.hash(keys[0])
    return F.shiftleft(first.cast("bigint"), 32) + F.hash(*keys) if keys[1:] else first


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", key_hash(keys))
        .withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1")
        .drop("_hash", "_rank")
    )


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``. NULL keys equal each other."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order``."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])
