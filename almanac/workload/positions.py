"""The place of each row in an ordered table, for queries that show an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.workload.scratch import scratch_dir


def with_position(ordered: DataFrame) -> DataFrame:
    """``position`` from 1 on, counted along the partitions of a sorted table.

    The rows are written with their ids first. Ids grow inside a partition, whose number is in
    their upper bits, so only one count per partition is added up in one task.
    """
    spark = ordered.sparkSession
    path = scratch_dir(spark, "positions")
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(counts, "_part").withColumn(
        "position", F.col("_before") + inside + 1).drop("_id", "_part", "_before")
