"""Values and dates out of raw page text, as constant-pattern native expressions.

Constant patterns are compiled once per task; only the second labelled pattern needs the
row's own label inside the regex, and it is reached only where the first one found nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.coerce import _col, clean_number, to_number

# --- fixed values -----------------------------------------------------------
TAG = r"<[^>]+>"
AMOUNT = r"([0-9][0-9,]*(?:\.[0-9]+)?)"
VERBS = [
    "fell to", "rose to", "increased to", "decreased to",
    "was at", "was", "stood at", "traded at",
]
MONTH_REFERENCE = r"in\s+([A-Za-z]+)\s+(\d{4})"
MONTHS = [
    "january", "february", "march", "april", "may", "june", "july",
    "august", "september", "october", "november", "december",
]
DAY_CELL = r"[A-Za-z]{3,9}\s+\d{1,2},\s+\d{4}"
TABLE_HEAD = r"Date\s*\|\s*Price.*?"
TABLE_RULE = r"\|\s*---.*?"
DAILY_SPAN = r"Daily\s+\d{1,2}[/-]\d{1,2}[/-]\d{4}\s*-\s*\d{1,2}[/-]\d{1,2}[/-]\d{4}.*?"
PERIOD_ROW = r"(\d{4}/\d{2})\s+([^\n\r]+)"
NO_DATA = "ND"
DEFAULT_POSITION = 5
# ----------------------------------------------------------------------------

# (?U) gives Unicode classes; the control separators are whitespace here as well.
SPACES = r"(?U)[\s\x1c-\x1f]+"
SPACES_IN_LINE = r"(?U)[\s\x1c-\x1f&&[^\n]]+"
LINE_END_TAG = r"(?i)</tr\s*>|<br\s*/?>"


def page_text(html: Column | str) -> Column:
    """Tags become one space, whitespace runs collapse to one space; nothing else changes."""
    return F.regexp_replace(F.regexp_replace(_col(html), TAG, " "), SPACES, " ")


def page_lines(html: Column | str) -> Column:
    """Page text that keeps its rows apart.

    In an HTML table a row ends at ``</tr>``, so source line breaks are only layout there;
    in plain pages the line break is the row end.
    """
    html = F.replace(_col(html), F.lit("\r"), F.lit("\n"))
    html = F.when(html.rlike(r"(?i)<tr[\s>]"), F.regexp_replace(html, SPACES, " ")).otherwise(html)
    marked = F.regexp_replace(html, LINE_END_TAG, "\n")
    return F.regexp_replace(F.regexp_replace(marked, TAG, " "), SPACES_IN_LINE, " ")


def _ascii_digits(c: Column) -> Column:
    return F.translate(c, "０１２３４５６７８９", "0123456789")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def labelled_value(text: Column | str, label: Column | str) -> Column:
    """Number after ``label … <verb phrase>``, else after ``label | Price |``."""
    text, label = _col(text), _col(label)
    by_verb = rf"(?s)(?:{'|'.join(VERBS)})\s+{AMOUNT}"

    # A later occurrence of the label cannot succeed where the first one fails, because the
    # gap to the verb may hold anything; so search once, behind the first occurrence.
    def behind_label(low: Column) -> Column:
        return let(F.instr(low, F.lower(label)), lambda at: F.when(
            at > 0,
            F.regexp_extract(F.substr(low, at + F.length(F.lower(label))), by_verb, 1)))

    literal = F.replace(label, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    by_price = F.call_function(
        "regexp_extract",
        text,
        F.concat(F.lit(r"(?ius)\Q"), literal, F.lit(r"\E\s+[|-]\s+Price\s+[|-].*?" + AMOUNT)),
        F.lit(1),
    )
    # No match is an empty string, which is no number.
    return F.coalesce(clean_number(let(F.lower(text), behind_label)), clean_number(by_price))


def month_reference(text: Column | str) -> Column:
    """First ``in <word> <year>``: struct of its ``day`` and whether it is ``bad``, no month.

    Both are NULL and false where the text has no such phrase.
    """
    pattern = r"(?U)" + MONTH_REFERENCE
    names = F.array(*[F.lit(m[:3]) for m in MONTHS])

    def read(found: Column) -> Column:
        word = F.lower(F.left(F.regexp_extract(found, pattern, 1), F.lit(3)))
        year = _ascii_digits(F.regexp_extract(found, pattern, 2))
        return let(F.array_position(names, word), lambda month: F.struct(
            F.when(month > 0, F.concat_ws("-", year, month, F.lit("1")).try_cast("date"))
            .alias("day"),
            ((found != "") & (month == 0)).alias("bad"),
        ))

    return let(F.regexp_extract(_col(text), pattern, 0), read)


def _named_day(cell: Column) -> Column:
    """``May 15, 2026``: the month as three letters or in full, in any case."""
    names = F.array(*[F.lit(m[:3]) for m in MONTHS], *[F.lit(m) for m in MONTHS])

    def read(parts: Column) -> Column:
        word, day, year = (F.get(parts, F.lit(i)) for i in range(3))
        return let(F.array_position(names, F.lower(word)), lambda at: F.when(
            at > 0, F.concat_ws("-", year, (at - 1) % len(MONTHS) + 1, day).try_cast("date")))

    return let(F.split(cell, r",?\s+"), read)


def price_row(text: Column | str, anchored: bool = True) -> Column:
    """First row of a piped price table as a struct of ``day`` and ``value``.

    The date is in the first row under the table's rule, else the first one after a daily
    span. ``anchored`` takes the number in the cell behind that date; without it the first
    number before a pipe is taken, which in a table that leads with ``May 15, 2026 |`` is the
    year.
    """
    text = _col(text)

    def match(where: Column, pattern: str) -> Column:
        return F.regexp_extract(where, pattern, 1)

    row = match(text, rf"(?is){TABLE_HEAD}{TABLE_RULE}({DAY_CELL}\s*\|[^|]*\|?)")
    after_span = match(text, rf"(?is){DAILY_SPAN}({DAY_CELL})")
    lead = rf"{DAY_CELL}\s*\|\s*" if anchored else ""
    loose = clean_number(match(text, rf"(?is)Historical Data.*?{TABLE_HEAD}{lead}{AMOUNT}"))
    first_number = clean_number(match(text, rf"(?is){TABLE_HEAD}{TABLE_RULE}{AMOUNT}\s*\|"))

    def read(found: Column) -> Column:
        day = F.coalesce(_named_day(match(found, rf"({DAY_CELL})")), _named_day(after_span))
        if anchored:
            behind = clean_number(match(found, rf"\|\s*{AMOUNT}\s*\|$"))
            value = F.when(found != "", behind).otherwise(loose)
        else:
            value = F.coalesce(first_number, loose)
        return F.struct(day.alias("day"), value.alias("value"))

    return let(row, read)


def period_rows(lines: Column | str) -> Column:
    """Every ``YYYY/MM <rest of line>`` as an array of ``(period, rest)``."""
    rows = F.regexp_extract_all(_col(lines), F.lit(r"(?U)" + PERIOD_ROW), F.lit(0))
    return F.transform(
        rows,
        lambda r: F.struct(
            F.regexp_extract(r, r"(?U)" + PERIOD_ROW, 1).alias("period"),
            F.regexp_extract(r, r"(?U)" + PERIOD_ROW, 2).alias("rest"),
        ),
    )


def period_day(period: Column | str) -> Column:
    text = F.replace(_ascii_digits(_col(period)), F.lit("/"), F.lit("-"))
    return F.concat(text, F.lit("-01")).try_cast("date")


def token_number(rest: Column | str, position: Column | str) -> Column:
    """The number at a 1-based whitespace token; NULL if missing, ``ND`` or no number."""
    tokens = F.filter(F.split(_col(rest), SPACES), lambda t: t != "")
    return let(F.get(tokens, _col(position) - 1), lambda token: F.when(
        token != NO_DATA, to_number(token)))
