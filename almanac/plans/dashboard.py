"""Queries behind the dashboard: facets, extent, trend, latest table, headline."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.coerce import coerce_day, coerce_numbers
from almanac.functions.display import delta_text, number_text
from almanac.operators.snapshot import in_table_order, latest_snapshot
from almanac.schemas import LATEST_TABLE_COLUMNS, PRICE_COLUMNS

FACETS = ["category", "region", "refresh"]
# --- fixed values -----------------------------------------------------------
DEFAULT_WINDOW_DAYS = 180
HEADLINE_CARDS = 4
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Selection:
    """Chosen facet values; None leaves a facet open, an empty list keeps nothing."""

    refresh: list[str] | None = None
    category: list[str] | None = None
    region: list[str] | None = None

    def condition(self) -> Column:
        kept = F.lit(True)
        for name in FACETS:
            values = getattr(self, name)
            if values is None:
                kept &= F.col(name).isNotNull()
            else:
                kept &= F.col(name).isin(values) if values else F.lit(False)
        return kept


def dataset(history: DataFrame) -> DataFrame:
    """History with typed dates and numbers, rows without date or close dropped."""
    rows = history.withColumn("date", coerce_day(history))
    rows = coerce_numbers(rows, [*PRICE_COLUMNS, "change", "change_pct"])
    return rows.where(F.col("date").isNotNull() & F.col("close").isNotNull())


def facet_values(df: DataFrame) -> DataFrame:
    """``(facet, value)`` of every distinct value, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in FACETS])
    return (
        df.select(*FACETS).distinct()
        .select(F.inline(pairs)).where("value is not null").distinct()
        .orderBy("facet", "value")
    )


def date_extent(df: DataFrame, days: int = DEFAULT_WINDOW_DAYS) -> DataFrame:
    """First and last day, and where the default window starts."""
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")).withColumn(
        "default_start", F.greatest("min_date", F.date_sub("max_date", days)))


def trend(df: DataFrame, selection: Selection, first: dt.date | str,
          last: dt.date | str) -> DataFrame:
    """Points of the selected series between two days, both included, a line per symbol."""
    lo, hi = (F.lit(str(d)).cast("date") for d in (first, last))
    return (
        df.where(selection.condition() & F.col("date").between(lo, hi))
        .select("indicator_name", "symbol", "date", "close")
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("symbol", "date", "close")])
    )


def latest_rows(df: DataFrame, selection: Selection, **order) -> DataFrame:
    """Snapshot of the whole dataset, then the selection: dates never narrow it."""
    return latest_snapshot(df, **order).where(selection.condition())


def latest_table(df: DataFrame, selection: Selection, **order) -> DataFrame:
    return in_table_order(latest_rows(df, selection, **order)).select(*LATEST_TABLE_COLUMNS)


def headline(latest: DataFrame, cards: int = HEADLINE_CARDS) -> DataFrame:
    """The largest percent changes with their display text; ties go by symbol."""
    return (
        latest.orderBy(F.desc_nulls_last("change_pct"), "symbol").limit(cards)
        .select(
            "symbol", "indicator_name", "close", "change_pct",
            number_text("close").alias("close_text"),
            delta_text("change_pct").alias("delta_text"),
        )
    )
