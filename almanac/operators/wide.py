"""Wide monthly index tables to tidy long rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.coerce import month_start, to_number
from almanac.functions.labels import classification
from almanac.operators.dedupe import keep_first
from almanac.operators.enrich import with_constants
from almanac.schemas import INDEX_COLUMNS

# --- fixed values -----------------------------------------------------------
TARGET_SERIES = {
    "企業物価指数 2020年基準/輸入物価指数/円ベース": "輸入物価指数/円ベース",
    "企業物価指数 2020年基準/消費税を除く国内企業物価指数": "消費税を除く国内企業物価指数",
}
INDEX_CONSTANTS = {
    "category": "Inflation",
    "region": "Japan",
    "refresh": "monthly",
    "source": "Bank of Japan",
    "unit": "Index 2020=100",
}
MONTH_NAME = r"^\d{6}$"
# ----------------------------------------------------------------------------

IDS = ["code", "series_name", "label_raw"]
LABELS = ["indicator_name", "classification1", "classification2"]
# The close comes last in the order, so that equal labels of a month can be split over tasks.
INDEX_ORDER = ["indicator_name", "date", "classification1", "classification2", "close"]
# What makes two long rows copies of each other.
COPY_KEY = ["date", "indicator_name", "classification1", "classification2", "close"]


def name_ids(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The first three columns become ``code``, ``series_name``, ``label_raw``."""
    own = [c for c in df.columns if c not in extra]
    return df.withColumnsRenamed(dict(zip(own[:3], IDS)))


def target_rows(df: DataFrame, names: dict[str, str] = TARGET_SERIES) -> DataFrame:
    return df.where(F.col("series_name").isin(list(names)))


def short_name(names: dict[str, str] = TARGET_SERIES) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.col("series_name"))


def with_labels(df: DataFrame, names: dict[str, str] = TARGET_SERIES) -> DataFrame:
    """Short name and label levels, taken once per wide row instead of once per cell."""
    level1, level2 = classification("label_raw")
    return df.withColumns({
        "indicator_name": short_name(names), "classification1": level1, "classification2": level2,
    })


def month_columns(df: DataFrame) -> list[str]:
    found = [c for c in df.columns if re.fullmatch(MONTH_NAME, c)]
    if not found:
        raise ValueError("the table has no month columns named YYYYMM")
    return found


def melt_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Month columns of a wide frame to ``(yyyymm, close)`` rows, NULL cells included."""
    return df.unpivot(IDS + list(keep), month_columns(df), "yyyymm", "close")


def name_cells(rows: DataFrame) -> DataFrame:
    """The first three cells of archive rows as ``code``, ``series_name``, ``label_raw``."""
    return rows.withColumns({name: F.get("cells", F.lit(i)) for i, name in enumerate(IDS)})


def melt_cells(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Month cells of archive rows, whose month columns differ from file to file.

    ``rows`` holds ``header`` and ``cells`` arrays; the months are picked per row, so no
    schema has to be found out up front.
    """
    behind = F.size("header")
    months = F.filter(
        F.arrays_zip(
            F.slice("header", F.lit(len(IDS) + 1), behind).alias("yyyymm"),
            F.slice("cells", F.lit(len(IDS) + 1), behind).alias("close"),
        ),
        lambda c: c["yyyymm"].rlike(MONTH_NAME),
    )
    return rows.select(*IDS, *keep, F.inline(months))


def tidy_index(long: DataFrame, order: list[str], strict_months: bool = True) -> DataFrame:
    """Numbers, dates and constants on labelled long cells, then the first of all copies."""
    rows = long.withColumn("close", to_number("close")).dropna(subset=["close"])
    rows = rows.withColumn("date", month_start("yyyymm", strict_months))
    if not strict_months:
        rows = rows.dropna(subset=["date"])
    rows = with_constants(rows, INDEX_CONSTANTS)
    return keep_first(rows, COPY_KEY, order).select(*INDEX_COLUMNS)


def in_index_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in INDEX_ORDER])
