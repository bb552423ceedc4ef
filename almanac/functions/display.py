"""Headline text: two decimals, thousands commas from 1000 up, signed percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.coerce import _col, no_nan

MISSING = "-"


def _two_decimals(c: Column, commas: bool) -> Column:
    text = F.format_number(c, 2)
    if not commas:
        text = F.replace(text, F.lit(","), F.lit(""))
    infinite = F.abs(c) == float("inf")
    return F.when(infinite, F.when(c > 0, "inf").otherwise("-inf")).otherwise(text)


def number_text(c: Column | str) -> Column:
    c = no_nan(_col(c))
    return (
        F.when(c.isNull(), MISSING)
        .when(F.abs(c) >= 1000, _two_decimals(c, commas=True))
        .otherwise(_two_decimals(c, commas=False))
    )


def delta_text(c: Column | str) -> Column:
    c = no_nan(_col(c))
    text = _two_decimals(c, commas=False)
    signed = F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))
    return F.when(c.isNull(), MISSING).otherwise(F.concat(signed, F.lit("%")))
