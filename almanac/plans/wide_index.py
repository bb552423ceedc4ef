"""Wide index archives to the tidy table and its exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from almanac.jobs import at_once
from almanac.operators.wide import (
    LABELS, TARGET_SERIES, in_index_order, melt_cells, melt_columns, name_cells, name_ids,
    target_rows, tidy_index, with_labels,
)
from almanac.sinks.csv import write_index, write_yearly
from almanac.sources.archives import archive_records, archive_rejects, read_archives


@dataclass(frozen=True)
class IndexRun:
    table: DataFrame
    rejects: DataFrame
    rows: int


def index_from_archives(rows: DataFrame, names: dict[str, str] = TARGET_SERIES,
                        strict_months: bool = True) -> DataFrame:
    """Tidy rows out of archive records; of copies the first in path and file order stays."""
    order = ["path", "row"]
    rows = with_labels(target_rows(name_cells(archive_records(rows)), names), names)
    return tidy_index(melt_cells(rows, (*order, *LABELS)), order, strict_months)


def index_from_table(wide: DataFrame, order: list[str], names: dict[str, str] = TARGET_SERIES,
                     strict_months: bool = True) -> DataFrame:
    """The same for a wide frame; ``order`` names the columns that give the row order."""
    wide = with_labels(target_rows(name_ids(wide, tuple(order)), names), names)
    return tidy_index(melt_columns(wide, (*order, *LABELS)), order, strict_months)


def ingest_records(records: DataFrame, out: str, bom: bool = True, years: range | None = None,
                   strict_months: bool = True) -> IndexRun:
    """Write unpacked archives, their tidy table and every export of it under ``out``.

    The records are written once, so that each archive is unpacked once and the rows of a large one
    are spread over tasks before they are melted; the exports read the written table. ``rejects``
    reads the records.
    """
    spark = records.sparkSession
    records.write.mode("overwrite").parquet(f"{out}/records")
    records = spark.read.schema(records.schema).parquet(f"{out}/records")
    index_from_archives(records, strict_months=strict_months).write.mode("overwrite").parquet(
        f"{out}/table")
    table = spark.read.parquet(f"{out}/table")
    _, _, rows = at_once(
        spark, lambda: write_index(table, f"{out}/index_csv", f"{out}/index_tsv", bom),
        lambda: write_yearly(table, f"{out}/yearly", f"{out}/yearly_lite", years, bom), table.count)
    return IndexRun(in_index_order(table), archive_rejects(records), rows)


def ingest_archives(spark: SparkSession, archives: str, out: str, bom: bool = True,
                    years: range | None = None, strict_months: bool = True) -> IndexRun:
    """Read archives under ``archives`` and write every export under ``out``."""
    return ingest_records(read_archives(spark, archives), out, bom, years, strict_months)
