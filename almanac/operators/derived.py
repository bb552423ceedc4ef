"""Series of a catalog out of raw series: taken as they are, or two multiplied day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.joins import lookup_join


def direct_legs(catalog: DataFrame) -> DataFrame:
    """The one input of every entry that names a series."""
    return catalog.where("series_id is not null").select(
        "symbol", "pos", F.lit(0).alias("leg"), "series_id", F.lit(1).alias("inputs"))


def product_legs(catalog: DataFrame) -> DataFrame:
    """The inputs of every two-input ``multiply`` entry, one row each."""
    return (
        catalog.where((F.col("formula") == "multiply") & (F.size("series_ids") == 2))
        .select("symbol", "pos", F.posexplode("series_ids").alias("leg", "series_id"))
        .withColumn("inputs", F.lit(2))
    )


def combine_series(series: DataFrame, legs: DataFrame, small: bool = False) -> DataFrame:
    """``(symbol, pos, date, close, fetched_at)`` for the days on which every input has a value.

    The join of two inputs on the day is one aggregation: every leg keeps its last value per
    ``(symbol, date)``, combined before the shuffle, so repeated days are never paired with
    each other. ``series`` is ``(series_id, date, close, seq)``, ``fetched_at`` is optional.
    """
    if "fetched_at" not in series.columns:
        series = series.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    values = series.select("series_id", "date", "close", "fetched_at", "seq")
    values = values.where(F.col("date").isNotNull() & F.col("close").isNotNull())
    matched = lookup_join(values, legs, "series_id", "inner", small)

    def last_of(leg: int):
        mine = F.col("leg") == leg
        return F.max_by(F.when(mine, F.col("close")), F.when(mine, F.col("seq")))

    single = F.col("inputs") == 1
    # The aggregation sorts; a leading number decides nearly every comparison on its prefix. It
    # keeps the days of an entry together, which makes the shuffled rows smaller than a hash does.
    place = F.shiftleft("pos", 20) + F.unix_date("date")
    return (
        matched.groupBy(place, "symbol", "pos", "date", "inputs")
        .agg(last_of(0).alias("left_close"), last_of(1).alias("right_close"),
             F.max("fetched_at").alias("fetched_at"))
        .withColumn("close", F.when(single, F.col("left_close")).otherwise(
            F.col("left_close") * F.col("right_close")))
        .where(F.col("close").isNotNull())
        .select("symbol", "pos", "date", "close",
                F.when(single, F.col("fetched_at")).alias("fetched_at"))
    )
