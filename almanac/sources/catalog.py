"""The indicator catalog: a JSON array of objects with differing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.schemas import CATALOG

# --- fixed values -----------------------------------------------------------
OHLCV = "yahoo"
SERIES = "fred"
DERIVED = "fred_derived"
PERIOD_PAGE = "boj_main_series"
LABELLED_PAGE = "tradingeconomics_latest"
PRICE_PAGE = "investing_historical_latest"
REQUIRED = ["symbol", "name", "category", "region", "source"]
# ----------------------------------------------------------------------------

KNOWN = [OHLCV, SERIES, DERIVED, PERIOD_PAGE, LABELLED_PAGE, PRICE_PAGE]


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog rows with their position ``pos``; keys an entry lacks are NULL.

    Of a folder the files count in the order of their paths; only the paths reach the driver. A file
    is read by one task, in which the generated ids grow.
    """
    rows = spark.read.schema(CATALOG).option("multiLine", True).json(path)
    file = F.col("_metadata.file_path")
    files = sorted(r[0] for r in rows.select(file.alias("file")).distinct().collect())
    place = F.array_position(F.array(*map(F.lit, files)).cast("array<string>"), file) - 1
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("pos", F.shiftleft(place, 33) + row)


def missing_keys() -> Column:
    """The keys an entry of a known type lacks, comma-separated; empty if it is complete."""
    required = [F.when(F.col(key).isNull(), key) for key in REQUIRED]
    series = F.when((F.col("source_type") == SERIES) & F.col("series_id").isNull(), "series_id")
    known = F.coalesce("source_type", F.lit(OHLCV)).isin(KNOWN)
    return F.when(known, F.concat_ws(", ", *required, series)).otherwise("")


def complete(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable entries, and the rejects among the others."""
    rejects = catalog.where(missing_keys() != "").select(
        "symbol", F.lit("catalog").alias("stage"),
        F.concat(F.lit("missing "), missing_keys()).alias("reason"))
    return catalog.where(missing_keys() == ""), rejects


def by_refresh(catalog: DataFrame, refresh: str | None) -> DataFrame:
    return catalog if refresh is None else catalog.where(F.col("refresh") == refresh)


def of_type(catalog: DataFrame, source_type: str) -> DataFrame:
    """Entries of one source type; an entry without a type counts as OHLCV."""
    return catalog.where(F.coalesce("source_type", F.lit(OHLCV)) == source_type)
