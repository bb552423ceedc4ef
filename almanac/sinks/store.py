"""History kept as parquet by version and year, published through a run log.

A run writes only the years it changes, under its own version directory, and then appends one
row to the run log saying which version holds each year. Readers follow the newest log row, so
they never see a half-written run, no file is overwritten while it is read, and unchanged years
are neither read nor written. One run at a time writes to a store: a run whose version was published
meanwhile by another one is refused. A run that failed is simply repeated under the same version.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.enrich import align
from almanac.operators.snapshot import yearly_tails
from almanac.jobs import at_once
from almanac.schemas import MIN_DATE, OBSERVATION

# What the log knows of one year: the version that holds it and its row counts.
YEAR = T.StructType([
    T.StructField(name, T.LongType())
    for name in ("version", "history", "lite", "daily", "monthly")
])
# Prices and names take about a quarter less of the disk than with Spark's default codec.
CODEC = "zstd"
RUN_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("run_at", T.TimestampType()),
    T.StructField("refresh", T.StringType()),
    T.StructField("years", T.MapType(T.StringType(), YEAR)),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
    T.StructField("segments", T.ArrayType(T.StringType())),
    # Where CSV exports go, and the version whose files hold the segments of each year.
    T.StructField("exports", T.StringType()),
    T.StructField("exported", T.MapType(T.StringType(), T.LongType())),
])


@dataclass(frozen=True)
class HistoryStore:
    spark: SparkSession
    path: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])

    def last_run(self) -> Row | None:
        try:
            log = self.spark.read.schema(RUN_LOG).json(self._at("runs"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.orderBy(F.desc("version")).limit(1).first()

    def years(self, run: Row | None) -> dict[int, dict[str, int]]:
        """Year to its log entry, as of ``run``."""
        return {} if run is None else {int(y): e.asDict() for y, e in run["years"].items()}

    def read(self, years: dict[int, dict[str, int]], table: str = "history") -> DataFrame:
        """The history of these years, as a partition filter over one table.

        The result keeps its ``year`` column; without years it is an empty table. ``"tails"``
        has the last two rows per symbol and year only.
        """
        held = {year: entry["version"] for year, entry in years.items()}
        if not held:
            return self.spark.createDataFrame(
                [], T.StructType([*OBSERVATION.fields, T.StructField("year", T.IntegerType())]))
        rows = (
            self.spark.read
            .schema(T.StructType([
                *OBSERVATION.fields,
                T.StructField("version", T.LongType()), T.StructField("year", T.IntegerType()),
            ]))
            .option("basePath", self._at(table))
            .parquet(*[self._at(table, f"version={v}") for v in sorted(set(held.values()))])
        )
        current = F.lit(False)
        for version in sorted(set(held.values())):
            its_years = [y for y, v in held.items() if v == version]
            current |= (F.col("version") == version) & F.col("year").isin(its_years)
        return rows.where(current).drop("version")

    def stage(self, df: DataFrame, name: str, version: int) -> tuple[DataFrame, int]:
        """Write an intermediate table once and read it back, with its number of rows.

        A lost executor then repeats a read, not the work behind it.
        """
        where = self._at(name, f"version={version}")
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").option("compression", CODEC).parquet(where)
        return self.spark.read.schema(df.schema).parquet(where), seen.get["rows"]

    def drop(self, name: str, version: int) -> None:
        """Replace an intermediate table that nothing reads any more by an empty one."""
        where = self._at(name, f"version={version}")
        self.spark.range(0, numPartitions=1).write.mode("overwrite").parquet(where)

    def write_years(self, history: DataFrame, version: int, floor: str = MIN_DATE,
                    clustered: bool = True, spent: str | None = None) -> dict[int, dict[str, int]]:
        """Observations under the version's directory, in symbol order inside every file.

        ``clustered`` also brings the rows of a symbol together across files; without it every
        task writes the rows it has, which keeps files that were clustered before as they are.
        The tails of these years are written beside them. ``spent`` names an intermediate that only the
        observations were read from, which goes before the tails come. Returns the log entries of the
        years that have rows, counted on what was written.
        """
        keys = ["year", "symbol", "date"]
        rows = align(history).withColumn("year", F.year("date"))
        where = self._at("history", f"version={version}")
        if clustered:
            rows = rows.repartitionByRange(*keys)
        rows.sortWithinPartitions(*keys).write.mode("overwrite").option(
            "compression", CODEC).partitionBy("year").parquet(where)
        if spent is not None:
            self.drop(spent, version)
        written = self.spark.read.schema(rows.schema).parquet(where)
        is_lite = (
            F.col("indicator_name").isNotNull() & F.col("close").isNotNull()
            & ~F.isnan("close") & (F.col("date") >= F.lit(floor).cast("date"))
        )
        counts = written.groupBy("year").agg(
            F.lit(version).alias("version"),
            F.count(F.lit(1)).alias("history"),
            F.count_if(is_lite).alias("lite"),
            F.count_if(is_lite & (F.col("refresh") == "daily")).alias("daily"),
            F.count_if(is_lite & (F.col("refresh") == "monthly")).alias("monthly"),
        )
        tails = yearly_tails(written).sortWithinPartitions("year").write.mode("overwrite").option(
            "compression", CODEC)
        _, found = at_once(
            self.spark,
            lambda: tails.partitionBy("year").parquet(self._at("tails", f"version={version}")),
            counts.collect)
        return {r["year"]: {k: r[k] for k in YEAR.names} for r in found}

    def publish(self, version: int, run_at, refresh: str | None,
                years: dict[int, dict[str, int]], metrics: dict[str, int],
                exports: str | None = None, exported: dict[int, int] | None = None) -> Row:
        last = self.last_run()
        if last is not None and last["version"] >= version:
            raise RuntimeError(f"version {version} was published by another run meanwhile")
        totals = {k: sum(e[k] for e in years.values()) for k in ("history", "lite")}
        monthly = ["history_monthly"] if any(e["monthly"] for e in years.values()) else []
        daily = [f"history_daily_{y}" for y, e in sorted(years.items()) if e["daily"]]
        row = (version, None, refresh, {str(y): e for y, e in years.items()},
               {**metrics, **totals}, daily + monthly, exports,
               {str(y): v for y, v in (exported or {}).items()})
        # As a literal, so that one row takes no Python worker.
        entry = F.from_json(F.lit(json.dumps(dict(zip(RUN_LOG.names, row)))), RUN_LOG)
        self.spark.range(1, numPartitions=1).select(entry.alias("entry")).select("entry.*").withColumn(
            "run_at", F.lit(run_at).cast("timestamp")).write.mode("append").json(self._at("runs"))
        return self.last_run()
