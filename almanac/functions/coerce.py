"""Dirty-input coercion. Every helper returns a native column; bad input becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Literals accepted as numbers. Spark's own cast also takes "1.5d", so it needs the guard.
NUMBER = r"^(?:\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*|[+-]?(?i:inf|infinity))\z"
# Year-month-day with one separator throughout; a time part may follow.
DAY = r"^\s*(\d{4}([-/])\d{1,2}\2\d{1,2})(?:[T ].*)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number is NULL."""
    c = _col(c)
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def no_nan(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def to_day(c: Column | str) -> Column:
    """Text to date; accepts ``-`` and ``/`` dates alike, NULL for the rest."""
    text = F.regexp_extract(_col(c), DAY, 1)
    return F.replace(text, F.lit("/"), F.lit("-")).try_cast("date")


def coerce_number(df: DataFrame, name: str) -> Column:
    """Number coercion chosen from the column's type at plan time."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_number(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return no_nan(F.col(name).cast("double"))
    return F.col(name).cast("double")


def coerce_day(df: DataFrame, name: str = "date") -> Column:
    """Date coercion chosen from the column's type at plan time."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_day(name)
    return F.col(name).cast("date")


def coerce_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    """Coerce those of ``names`` that the frame has."""
    return df.withColumns({n: coerce_number(df, n) for n in names if n in df.columns})


def iso_day(c: Column | str) -> Column:
    return _col(c).cast("date").cast("string")


def iso_instant(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def clean_number(c: Column | str) -> Column:
    """Drop thousands commas, then read as double."""
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast("double")


def month_start(yyyymm: Column | str, strict: bool = True) -> Column:
    """First day of a ``YYYYMM`` month. Strict raises on a bad month, else NULL."""
    text = F.concat(_col(yyyymm), F.lit("01"))
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


def strip(c: Column | str) -> Column:
    """Strip Unicode whitespace, the ideographic space included."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def or_default(c: Column | str, default: object = "") -> Column:
    return F.coalesce(_col(c), F.lit(default))
