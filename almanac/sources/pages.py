"""Observations out of landed pages.

Each kind of page is an array expression of hits, so that one generator over the pages can
serve all kinds at once. The page text is bound once inside the expression, and later filters
stay above the generator, so no pattern is matched twice on a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import pagetext as P

BAD_MONTH = "month reference is not a month"


def _hit(date: Column, close: Column, bad: Column | None = None) -> Column:
    return F.struct(
        date.alias("date"), close.alias("close"),
        (F.lit(False) if bad is None else bad).alias("bad"))


def _of_text(make: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(P.page_text("html")), make)


def labelled_hits() -> Column:
    """Value behind ``label``, dated by the month it refers to or by the fetch day."""
    return _of_text(lambda text: P.let(P.month_reference(text), lambda month: _hit(
        F.coalesce(month["day"], F.col("fetched_at").cast("date")),
        P.labelled_value(text, F.col("label")),
        month["bad"],
    )))


def price_hits(anchored: bool = True) -> Column:
    """First row of a piped price table."""
    return _of_text(lambda text: P.let(
        P.price_row(text, anchored), lambda row: _hit(row["day"], row["value"])))


def period_hits() -> Column:
    """One hit per ``YYYY/MM`` line, the number at token ``position``."""
    return F.transform(P.period_rows(P.page_lines("html")), lambda line: _hit(
        P.period_day(line["period"]), P.token_number(line["rest"], F.col("position"))))


def page_hits(pages: DataFrame, hits: Column) -> DataFrame:
    """The hits of all pages as rows; a hit without a value is none."""
    rows = pages.select("symbol", "pos", "fetched_at", F.posexplode(hits).alias("row", "_hit"))
    return rows.select(
        "symbol", "pos", "_hit.date", "_hit.close", "fetched_at",
        F.col("row").cast("bigint").alias("row"), "_hit.bad",
    ).where(F.col("close").isNotNull())


def split_hits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dated hits, and the rejects: pages with a value but an unreadable month."""
    good = rows.where(~F.col("bad") & F.col("date").isNotNull()).drop("bad")
    rejects = rows.where("bad").select(
        "symbol", F.lit("pages").alias("stage"), F.lit(BAD_MONTH).alias("reason"))
    return good, rejects


def page_rows(pages: DataFrame, hits: Column) -> tuple[DataFrame, DataFrame]:
    return split_hits(page_hits(pages, hits))
