"""CSV tables at rest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.coerce import empty_to_null, to_day, to_number
from almanac.operators.enrich import align
from almanac.schemas import OBSERVATION, PRICE_COLUMNS, SEQ


def read_text_table(spark: SparkSession, path: str, sep: str = ",",
                    multi_line: bool = False) -> DataFrame | None:
    """Header CSV as strings, empty cells NULL, with the order of files and lines in ``seq``.

    ``multi_line`` allows line breaks inside quotes, for which a file cannot be split. None if
    the path does not exist.
    """
    try:
        rows = spark.read.options(
            header=True, sep=sep, escape='"', multiLine=multi_line).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    names = rows.columns
    seq = F.struct(
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(None).cast("timestamp").alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(*[empty_to_null(f"`{c}`").alias(c) for c in names], seq.alias("seq"))


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """A history or lite CSV in the observation layout; empty if the path does not exist."""
    rows = read_text_table(spark, path)
    if rows is None:
        return spark.createDataFrame(
            [], T.StructType([*OBSERVATION.fields, T.StructField("seq", SEQ)]))
    typed = {c: to_number(c) for c in PRICE_COLUMNS if c in rows.columns}
    if "date" in rows.columns:
        typed["date"] = to_day("date")
    if "fetched_at" in rows.columns:
        typed["fetched_at"] = F.col("fetched_at").try_cast("timestamp")
    return align(rows.withColumns(typed), keep=("seq",))
