"""Latest value of every symbol with its change against the row before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

TABLE_ORDER = ["refresh", "category", "region", "indicator_name", "symbol"]


def _newest_first(keys: list[str], by: list[str]) -> WindowSpec:
    """Last row first; a NULL date or name is the last one, as in ascending order it is."""
    return Window.partitionBy("_hash", *keys).orderBy(*[
        F.col(c).desc_nulls_first() if c in ("date", "indicator_name")
        else F.col(c).desc_nulls_last() for c in by
    ])


def newest_rows(df: DataFrame, keys: list[str], rows: int, by: list[str]) -> DataFrame:
    """The last ``rows`` rows per key, with ``_age`` from 1; no more are shuffled per task."""
    return (
        df.withColumn("_hash", F.hash(*keys))
        .withColumn("_age", F.row_number().over(_newest_first(keys, by)))
        .where(F.col("_age") <= rows)
    )


def yearly_tails(history: DataFrame) -> DataFrame:
    """The last two rows per symbol and ``year``.

    The snapshot of the tails of all years is the snapshot of the history, so a run that changes
    one year has to read no other year's rows.
    """
    return newest_rows(history, ["symbol", "year"], 2, ["date"]).drop("_hash", "_age")


def latest_snapshot(df: DataFrame, name_first: bool = False,
                    order: list[str] | None = None) -> DataFrame:
    """Last row per symbol plus ``prev_close``, ``change`` and ``change_pct``.

    Only the two newest rows of a symbol matter, so they are selected first: Spark limits
    every task to two rows per symbol before the exchange, and the previous value is then
    read from a two-row window. ``name_first`` orders by name before date, which matters
    only for symbols that were renamed.
    """
    by = ["date"] + (order if order is not None else ["seq"] if "seq" in df.columns else [])
    if name_first:
        by = ["indicator_name"] + by
    two = newest_rows(df.where(F.col("symbol").isNotNull()), ["symbol"], 2, by)
    previous = F.lead("close").over(_newest_first(["symbol"], by))
    return (
        two.withColumn("prev_close", previous)
        .where("_age = 1")
        .withColumn("change", F.col("close") - F.col("prev_close"))
        .withColumn("change_pct", F.try_divide(F.col("change"), F.col("prev_close")) * 100)
        .drop("_age", "_hash", "seq")
    )


def in_table_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in TABLE_ORDER])
