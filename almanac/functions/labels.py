"""Two-level classification labels of the wide index tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.coerce import _col, strip

# --- fixed values -----------------------------------------------------------
TOTAL = "総平均"
# ----------------------------------------------------------------------------


def classification(label: Column | str) -> tuple[Column, Column]:
    """``(level 1, level 2)`` of a raw label; a NULL label gives ``(NULL, "")``."""
    text = strip(_col(label))
    total = text.contains(TOTAL)
    parts = F.split(text, "/", 2)
    rest = strip(F.regexp_replace(F.get(parts, F.lit(1)), "^_+", ""))
    # Without a slash the split has one part, which is the whole label.
    first = F.when(total, TOTAL).otherwise(strip(F.get(parts, F.lit(0))))
    second = F.when(total | ~text.contains("/") | text.isNull(), "").otherwise(rest)
    return first, second
