"""CSV and TSV exports.

Exports are range-partitioned by their sort order, so the part files are sorted, follow each
other in order, and one large year or cadence is written by several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.coerce import iso_day, iso_instant
from almanac.operators.history import name_order, segments
from almanac.operators.wide import INDEX_ORDER
from almanac.schemas import INDEX_COLUMNS, INDEX_LITE_COLUMNS, LITE_COLUMNS, MIN_DATE

BOM = "\ufeff"
# Text as it is: spaces stay, quotes are doubled, empty and missing look alike.
CSV_TEXT = {
    "escape": '"', "emptyValue": "", "nullValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def as_text(df: DataFrame) -> DataFrame:
    """Dates and instants in their ISO text form."""
    edge = {T.DateType(): iso_day, T.TimestampType(): iso_instant}
    return df.withColumns({
        f.name: edge[f.dataType](f.name) for f in df.schema.fields if f.dataType in edge
    })


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, sep: str = ",",
              bom: bool = True, partition_by: tuple[str, ...] = (), files: int | None = None,
              mode: str = "overwrite") -> None:
    """Header CSV; ``bom`` starts every file with a byte order mark.

    With ``order`` the part files are sorted, NULLs last. With ``partition_by`` only the
    partitions present in ``df`` are replaced; those columns are directories, not in the files.
    """
    out = as_text(df)
    names = {c: c for c in out.columns}
    if bom:
        first = next(c for c in out.columns if c not in partition_by)
        names[first] = BOM + first
        out = out.withColumnRenamed(first, names[first])
    if order:
        # The sort comes last and leads with the directory columns in the writer's own order,
        # else the writer would sort again, by the directories alone.
        keys = [F.col(c).asc() for c in partition_by]
        keys += [F.col(names[c]).asc_nulls_last() for c in order]
        by = ([files] if files else []) + keys
        out = out.repartitionByRange(*by).sortWithinPartitions(*keys)
    writer = out.write.mode(mode).options(**CSV_TEXT, header=True, sep=sep)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.csv(path)


def write_segments(history: DataFrame, path: str, bom: bool = True,
                   files: int | None = None, floor: str = MIN_DATE) -> None:
    """Lite rows by cadence and year; segments without rows keep their old files."""
    # A directory column is not in the file, which has to keep ``refresh``. A string directory
    # has to be free of NULLs, or the writer converts it and sorts again.
    rows = segments(history, floor).withColumn("cadence", F.coalesce("refresh", F.lit("")))
    write_csv(rows, path, name_order(rows), bom=bom, files=files,
              partition_by=("cadence", "year"))


def read_segments(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame:
    """Segment rows as text, of each year from the version that holds it, with ``cadence, year``."""
    schema = ", ".join(f"`{c}` string" for c in LITE_COLUMNS)
    if not versions:
        return spark.createDataFrame([], f"{schema}, cadence string, year int")
    rows = (
        spark.read.options(header=True, basePath=path)
        .schema(f"{schema}, version bigint, cadence string, year int")
        .csv([f"{path}/version={v}" for v in sorted(set(versions.values()))])
    )
    current = F.lit(False)
    for version in sorted(set(versions.values())):
        its_years = [y for y, v in versions.items() if v == version]
        current |= (F.col("version") == version) & F.col("year").isin(its_years)
    return rows.where(current).drop("version")


def write_yearly(index: DataFrame, path: str, lite_path: str, years: range | None = None,
                 bom: bool = True, files: int | None = None) -> None:
    """Full and lite index rows by year; a year without rows gets no file.

    ``years`` limits the export; by default every year is exported. The rows are read four times (two
    outputs, each sampled for its ranges), so ``index`` should be a written table.
    """
    rows = index.withColumn("year", F.year("date"))
    if years is not None:
        rows = rows.where(F.col("year").between(years.start, years.stop - 1))
    for columns, where in (([*INDEX_COLUMNS], path), ([*INDEX_LITE_COLUMNS], lite_path)):
        write_csv(rows.select(*columns, "year"), where, INDEX_ORDER, bom=bom, files=files,
                  partition_by=("year",))


def write_index(index: DataFrame, csv_path: str, tsv_path: str, bom: bool = True,
                files: int | None = None) -> None:
    """The full table as CSV and its five lite columns as TSV."""
    write_csv(index.select(*INDEX_COLUMNS), csv_path, INDEX_ORDER, bom=bom, files=files)
    write_csv(index.select(*INDEX_LITE_COLUMNS), tsv_path, INDEX_ORDER, sep="\t", bom=bom,
              files=files)
