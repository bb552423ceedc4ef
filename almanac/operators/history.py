"""History of observations: cleaning, upsert, active symbols, lite rows, export segments."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.coerce import coerce_day, coerce_number, coerce_numbers
from almanac.operators.dedupe import keep_last
from almanac.operators.enrich import align
from almanac.operators.joins import lookup_join
from almanac.schemas import LITE, LITE_COLUMNS, MIN_DATE, PRICE_COLUMNS

KEY = ["symbol", "date"]


def since(df: DataFrame, floor: str | dt.date = MIN_DATE) -> DataFrame:
    """Rows at or after the floor; a NULL date is neither."""
    return df.where(F.col("date") >= F.lit(str(floor)).cast("date"))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_observations(df: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """Coerce prices and dates, drop rows without date or close, apply the floor."""
    df = coerce_numbers(df, PRICE_COLUMNS).withColumn("date", coerce_day(df))
    return since(df, floor).where(F.col("close").isNotNull())


def latest_arrivals(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per ``(symbol, date)``: the one that arrived last."""
    return keep_last(df, KEY, order or ["seq"])


def _both_sides(existing: DataFrame, new: DataFrame, floor: str) -> DataFrame:
    """Cleaned rows of both with the batch they came in, of which 1 is the newer one."""

    def side(df: DataFrame, batch: int) -> DataFrame:
        if "seq" not in df.columns:
            df = df.withColumn("seq", F.lit(None))
        df = df.withColumn("date", coerce_day(df))
        df = align(coerce_numbers(df, PRICE_COLUMNS), keep=("seq",))
        return since(df, floor).withColumn("_batch", F.lit(batch))

    return side(existing, 0).unionByName(side(new, 1))


def upsert(existing: DataFrame, new: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """New rows replace old ones with the same ``(symbol, date)``.

    Both sides are always cleaned and deduplicated, so repeating an upsert changes nothing.
    A NULL close in new data replaces an old value.
    """
    both = _both_sides(existing, new, floor)
    return keep_last(both, KEY, ["_batch", "seq"]).drop("_batch", "seq")


def upsert_by_year(existing: DataFrame, new: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """The rows of ``upsert`` in ranges of ``year``, symbol and date, as a store's files are laid out.

    The exchange that lays the rows out also brings the rows of a key together, so there is no other.
    It ships the copies of a key: for sides that have few, as a store and a fetched batch do.
    """
    both = _both_sides(existing, new, floor).withColumn("year", F.year("date"))
    ranges = ["year", *KEY]
    order = [F.col(c).desc_nulls_last() for c in ("_batch", "seq")]
    place = F.row_number().over(Window.partitionBy(*ranges).orderBy(*order))
    laid_out = both.repartitionByRange(*ranges).withColumn("_rank", place)
    return laid_out.where("_rank = 1").drop("_batch", "seq", "year", "_rank")


def replace_rows(existing: DataFrame, batch: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """The upsert of a batch whose keys were measured to fit a broadcast, without a shuffle.

    Both sides are clean and unique per ``(symbol, date)`` already: ``existing`` as read from
    the store, ``batch`` as fetched. Old rows stay where they are unless the batch has their key or
    they are below the floor, so the rows are those of ``upsert``.
    """
    existing, batch = since(existing, floor), since(batch, floor)
    keys = batch.select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date"))
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("date") == F.col("_date"))
    kept = existing.join(F.broadcast(keys), same, "left_anti")
    return align(kept).unionByName(align(batch))


def active_symbols(catalog: DataFrame) -> DataFrame:
    return catalog.select("symbol").where("symbol <> ''").distinct()


def keep_active(df: DataFrame, active: DataFrame, small: bool = False) -> DataFrame:
    """Rows whose symbol is in ``active``; an empty set keeps nothing."""
    return lookup_join(df, active, "symbol", "left_semi", small)


def upsert_active(existing: DataFrame, new: DataFrame, active: DataFrame,
                  floor: str = MIN_DATE, small: bool = False) -> DataFrame:
    """Upsert of active symbols. The symbol is part of the key, so both sides are filtered first."""
    existing, new = (keep_active(df, active, small) for df in (existing, new))
    return upsert(existing, new, floor)


def lite(df: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """Six-column projection of complete rows; copies are kept."""
    rows = align(df, LITE)
    rows = rows.withColumns({"date": coerce_day(rows), "close": coerce_number(rows, "close")})
    return since(rows, floor).where(
        F.col("indicator_name").isNotNull() & F.col("close").isNotNull())


def segments(df: DataFrame, floor: str = MIN_DATE) -> DataFrame:
    """Lite rows of the two exported cadences with the ``year`` they are exported under."""
    rows = lite(df, floor).where(F.col("refresh").isin("monthly", "daily"))
    return rows.select(*LITE_COLUMNS, F.year("date").alias("year"))


def name_order(df: DataFrame) -> list[str]:
    """Sort columns: ``indicator_name, date``, then what tells rows of one name and day apart.

    Without the latter a sort could not split a large group of equal keys over tasks.
    """
    more = [c for c in ("symbol", "close", "category", "region") if c in df.columns]
    return ["indicator_name", "date", *more]


def in_name_order(df: DataFrame) -> DataFrame:
    """Global order by ``indicator_name, date``, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in name_order(df)])
