"""Landed OHLCV tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.schemas import OHLCV_NAMES, PRICE_COLUMNS

LOOKBACK_MONTHS = 12


def ohlcv_values(raw: DataFrame, as_of: dt.date | None = None,
                 months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Raw names to observation names, cut to the lookback ending at ``as_of``.

    Columns a vendor leaves out are NULL. Of two rows on a day the later time counts.
    """
    rows = raw.withColumnsRenamed(OHLCV_NAMES)
    absent = {c: F.lit(None).cast("double") for c in PRICE_COLUMNS if c not in rows.columns}
    rows = rows.withColumns(absent) if absent else rows
    if as_of is not None:
        first = F.add_months(F.lit(as_of), -months)
        rows = rows.where(F.col("date") >= first)
    return rows.withColumn("row", F.unix_micros(F.col("date").cast("timestamp")))
