"""Two-column series downloads, one CSV body per landed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.coerce import strip, to_day, to_number

# What is left of a line by ``strip``, unless nothing is.
VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def read_series_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed series files as bodies; the file's stem is the series id."""
    rows = spark.read.text(path, wholetext=True)
    stem = F.regexp_extract("_metadata.file_path", r"([^/]+)\.[^./]*$", 1)
    return rows.select(
        F.url_decode(stem).alias("series_id"),
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
    )


def _cells(line: Column) -> Column:
    quoted = F.transform(
        F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)'),
        lambda c: F.replace(F.regexp_replace(c, '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')),
    )
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def series_values(bodies: DataFrame) -> DataFrame:
    """``(series_id, date, close, fetched_at, row)`` of every parsed body line with a number.

    The date column is the one named ``DATE`` in any case, else the first; the value column
    is the one named like the series, else the second. A body without a second column, or
    without lines, has no rows. Lines are parsed inside the array, so each one is split once.
    """
    text = F.regexp_replace("body", "^\ufeff", "")
    lines = F.filter(F.split(text, r"\r\n|\n|\r"), lambda x: x.rlike(VISIBLE))

    def place(found: Column, fallback: int) -> Column:
        other = F.when(F.size("_names") >= fallback, fallback)
        return F.when(found > 0, found.cast("int")).otherwise(other) - 1

    upper = F.transform("_names", lambda n: F.upper(n))
    head = (
        bodies.select("series_id", "fetched_at", lines.alias("_lines"))
        .withColumn("_names", F.transform(_cells(F.get("_lines", F.lit(0))), strip))
        .withColumn("_date_at", place(F.array_position(upper, F.lit("DATE")), 1))
        .withColumn("_value_at", place(F.array_position("_names", F.col("series_id")), 2))
    )
    parsed = F.transform(
        F.transform(F.slice("_lines", F.lit(2), F.size("_lines")), _cells),
        lambda cells: F.struct(
            to_day(F.get(cells, F.col("_date_at"))).alias("date"),
            to_number(F.get(cells, F.col("_value_at"))).alias("close"),
        ),
    )
    rows = head.select("series_id", "fetched_at", F.posexplode(parsed).alias("row", "_hit"))
    return rows.select(
        "series_id", "_hit.date", "_hit.close", "fetched_at",
        F.col("row").cast("bigint").alias("row"),
    ).dropna(subset=["close"])
