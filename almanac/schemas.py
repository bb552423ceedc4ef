"""Fixed column layouts and the history floor."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
MIN_DATE = "2020-01-01"

PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]

OBSERVATION_COLUMNS = [
    "date", "open", "high", "low", "close", "adj_close", "volume",
    "symbol", "indicator_name", "category", "region", "refresh", "source", "unit", "fetched_at",
]

LITE_COLUMNS = ["date", "indicator_name", "category", "region", "refresh", "close"]

LATEST_TABLE_COLUMNS = [
    "indicator_name", "category", "region", "refresh", "date",
    "close", "change", "change_pct", "unit", "source",
]

INDEX_COLUMNS = [
    "date", "indicator_name", "classification1", "classification2", "close", "category",
    "region", "refresh", "source", "unit", "code", "series_name", "label_raw",
]

INDEX_LITE_COLUMNS = ["date", "indicator_name", "classification1", "classification2", "close"]

# Raw OHLCV header -> observation column.
OHLCV_NAMES = {
    "Date": "date", "Open": "open", "High": "high", "Low": "low",
    "Close": "close", "Adj Close": "adj_close", "Volume": "volume",
}
# ----------------------------------------------------------------------------

CATALOG = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("refresh", T.StringType()),
    T.StructField("series_id", T.StringType()),
    T.StructField("series_ids", T.ArrayType(T.StringType())),
    T.StructField("formula", T.StringType()),
    T.StructField("page_label", T.StringType()),
    T.StructField("series_position", T.IntegerType()),
])

# Arrival order of an observation: catalog position, fetch time, then place in the landed
# body. Structs compare field by field, so the largest ``seq`` is the row that came last.
SEQ = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])


def _field_type(name: str) -> T.DataType:
    if name == "date":
        return T.DateType()
    if name == "fetched_at":
        return T.TimestampType()
    if name in PRICE_COLUMNS or name in ("prev_close", "change", "change_pct"):
        return T.DoubleType()
    return T.StringType()


def layout(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _field_type(c)) for c in columns])


OBSERVATION = layout(OBSERVATION_COLUMNS)
LITE = layout(LITE_COLUMNS)
