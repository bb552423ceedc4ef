"""All landed sources of a catalog as one clean, deduplicated set of observations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.pagetext import DEFAULT_POSITION
from almanac.operators.derived import combine_series, direct_legs, product_legs
from almanac.operators.enrich import align, flat_prices, metadata
from almanac.operators.history import clean_observations, latest_arrivals, since, union_sources
from almanac.operators.joins import lookup_join
from almanac.schemas import MIN_DATE
from almanac.sources import catalog as C
from almanac.sources.ohlcv import ohlcv_values
from almanac.sources.pages import (
    labelled_hits, page_hits, period_hits, price_hits, split_hits,
)
from almanac.sources.series import series_values


#: Writes an intermediate under a name and returns what was written.
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Landing:
    """What the downloads left; a source that was not fetched is None."""

    series: DataFrame | None = None
    ohlcv: DataFrame | None = None
    pages: DataFrame | None = None


@dataclass(frozen=True)
class Fetched:
    observations: DataFrame
    rejects: DataFrame


def _arrival(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.struct(
        F.col("pos").cast("bigint").alias("pos"),
        F.col("fetched_at").alias("at"),
        F.lit(None).cast("string").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("row").cast("bigint").alias("row"),
    ))


def _series(landing: Landing, catalog: DataFrame, floor: str, small: bool,
            keep: Keep | None) -> DataFrame:
    """Direct and derived entries in one pass over the bodies."""
    values = series_values(landing.series).withColumn("seq", F.struct("fetched_at", "row"))
    legs = direct_legs(C.of_type(catalog, C.SERIES)).unionByName(
        product_legs(C.of_type(catalog, C.DERIVED)))
    rows = combine_series(values, legs, small)
    rows = rows if keep is None else keep(since(rows, floor), "series")
    return flat_prices(rows.withColumn("row", F.lit(0).cast("bigint")))


def _ohlcv(landing: Landing, catalog: DataFrame, as_of, months: int, small: bool) -> DataFrame:
    values = ohlcv_values(landing.ohlcv, as_of, months)
    wanted = C.of_type(catalog, C.OHLCV).select("symbol", "pos")
    return lookup_join(values, wanted, "symbol", small=small)


def _pages(landing: Landing, catalog: DataFrame, anchored: bool, small: bool,
           keep: Keep | None) -> tuple[DataFrame, DataFrame]:
    """Every kind of page in one pass."""
    kind = F.col("source_type")
    wanted = catalog.where(kind.isin(C.PERIOD_PAGE, C.LABELLED_PAGE, C.PRICE_PAGE)).select(
        "symbol", "pos", "source_type",
        F.coalesce("page_label", "name").alias("label"),
        F.coalesce("series_position", F.lit(DEFAULT_POSITION)).alias("position"),
    )
    # Copies of one download give the same observations, which are deduplicated later; the pages
    # themselves are compared with nothing.
    pages = landing.pages.select("symbol", "html", "fetched_at")
    joined = lookup_join(pages, wanted, "symbol", small=small)
    hits = (
        F.when(kind == C.PERIOD_PAGE, period_hits())
        .when(kind == C.LABELLED_PAGE, labelled_hits())
        .otherwise(price_hits(anchored))
    )
    rows = page_hits(joined, hits)
    good, rejects = split_hits(rows if keep is None else keep(rows, "page_hits"))
    return flat_prices(good), rejects.distinct()


def _landed(df: DataFrame | None, now) -> DataFrame | None:
    """A download without a time counts as fetched now, before anything is compared by it."""
    return df if df is None else df.withColumn("fetched_at", F.coalesce("fetched_at", now))


def fetch(catalog: DataFrame, landing: Landing, run_at: dt.datetime | None = None,
          floor: str = MIN_DATE, lookback_months: int = 12, anchored: bool = True,
          small: bool = False, keep: Keep | None = None) -> Fetched:
    """Observations of every catalog entry whose source has landed.

    Entries of an unknown type, and entries without a landed source, give no rows; entries
    that lack a required key are rejects. Metadata is
    attached after the deduplication, when a symbol has at most one row per day left. ``small``
    says that the catalog was measured to fit a broadcast; it changes how Spark joins and nothing
    else. ``keep``
    may write a named intermediate and return what it wrote: page hits serve both the
    observations and the rejects, and are far smaller than the pages; combined series and the latest
    arrivals end the shuffles behind them, so that not all of a run's shuffles hold disk at once.
    """
    now = F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")
    landing = Landing(*(_landed(df, now) for df in (landing.series, landing.ohlcv, landing.pages)))
    frames: list[DataFrame] = []
    catalog, rejects = C.complete(catalog)
    if landing.series is not None:
        frames.append(_series(landing, catalog, floor, small, keep))
    if landing.ohlcv is not None:
        as_of = None if run_at is None else run_at.date()
        frames.append(_ohlcv(landing, catalog, as_of, lookback_months, small))
    if landing.pages is not None:
        from_pages, rejected = _pages(landing, catalog, anchored, small, keep)
        frames.append(from_pages)
        rejects = rejects.unionByName(rejected)
    if not frames:
        return Fetched(align(catalog.limit(0)), rejects)
    names = ["symbol", "pos", "date", "open", "high", "low", "close", "adj_close", "volume",
             "fetched_at", "row"]
    raw = union_sources([
        f.select(*[F.col(c).cast("date") if c == "date" else F.col(c) for c in names])
        for f in frames
    ])
    # A derived value has no download of its own.
    raw = _arrival(raw.withColumn("fetched_at", F.coalesce("fetched_at", now)))
    # What the arrival order holds is shuffled once, and read from it again.
    raw = raw.drop("pos", "fetched_at", "row")
    unique = latest_arrivals(clean_observations(raw, floor)).withColumns(
        {"pos": F.col("seq.pos"), "fetched_at": F.col("seq.at")})
    unique = unique if keep is None else keep(unique, "latest")
    about = metadata(catalog, "pos")
    return Fetched(
        align(lookup_join(unique, about, "pos", small=small), keep=("seq",)),
        rejects,
    )
