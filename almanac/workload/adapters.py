"""The given tables seen as indicator data.

The tables hold no indicators, so events, orders, line items, parts and pages stand in for
observations, catalogs and raw downloads. Every adapter uses its table as a whole.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.pagetext import MONTHS
from almanac.operators.joins import lookup_join
from almanac.operators.wide import TARGET_SERIES
from almanac.schemas import CATALOG
from almanac.sources import catalog as C

ORDER_FLOOR = "1998-01-01"
TARGETS = list(TARGET_SERIES)
OTHER_SERIES = "other series"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_observations(spark: SparkSession, sf: str) -> DataFrame:
    """One observation per event; the event id is the arrival order."""
    user = F.col("user_id")
    symbol = text(F.col("event_type"), "_", user)
    return table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("close"),
        symbol.alias("symbol"),
        symbol.alias("indicator_name"),
        F.col("event_type").alias("category"),
        text("R", user % 5).alias("region"),
        F.when(user % 10 == 0, "monthly").otherwise("daily").alias("refresh"),
        F.lit("events").alias("source"),
        F.lit("").alias("unit"),
        F.col("event_id").alias("seq"),
    )


def order_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals by nation."""
    nation = F.col("n_nationkey")
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == nation)
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name")
    )
    return (
        lookup_join(orders, customers, "c_custkey")
        .select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_totalprice").alias("close"),
            text("N", nation).alias("symbol"),
            F.col("n_name").alias("indicator_name"),
            F.col("c_mktsegment").alias("category"),
            F.col("r_name").alias("region"),
            F.when(nation % 5 == 0, "monthly").otherwise("daily").alias("refresh"),
            F.col("o_orderkey").alias("seq"),
        )
    )


def customer_series(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw rows of one series per customer."""
    return table(spark, sf, "orders").select(
        text("C", F.col("o_custkey")).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderkey").alias("seq"),
    )


def catalog_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """Catalog layout with the given columns set and the others NULL."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
          for f in CATALOG.fields],
        columns["pos"].cast("bigint").alias("pos"),
    )


def customer_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as catalog; those in debt have no symbol, some have no unit."""
    key = F.col("c_custkey")
    return catalog_rows(
        table(spark, sf, "customer"),
        symbol=F.when(F.col("c_acctbal") < 0, "").otherwise(text("C", key)),
        name=F.col("c_name"),
        category=F.col("c_mktsegment"),
        region=text("N", F.col("c_nationkey")),
        source=F.lit("orders"),
        source_type=F.lit(C.OHLCV),
        unit=F.when(F.col("c_mktsegment") != "BUILDING", "USD"),
        refresh=F.when(F.col("c_nationkey") % 5 != 0, "daily"),
        pos=key,
    )


def part_month() -> Column:
    """Month name that a part's page refers to."""
    names = F.array(*[F.lit(m.capitalize()) for m in MONTHS])
    return F.element_at(names, F.col("p_size") % 12 + 1)


def part_pages(spark: SparkSession, sf: str, lead: Column | str = "") -> DataFrame:
    """A page per part that states its price behind a label, in one of two wordings."""
    price = F.format_number("p_retailprice", 2)
    label = text("Retail price of part ", F.col("p_partkey"))
    spoken = text(
        "<p>", F.col("p_name"), "</p> <b>", label, "</b> rose to ", price, " in ",
        part_month(), " 2024")
    piped = text(
        "<div>", F.col("p_name"), "<b>", label, "</b> | Price | <i>", price, "</i>\n seen in ",
        part_month(), "\n2024</div>")
    return table(spark, sf, "part").select(
        text("P", F.col("p_partkey")).alias("symbol"),
        F.col("p_partkey").alias("pos"),
        F.lit(None).cast("string").alias("url"),
        text(lead, F.when(F.col("p_type") == "ECONOMY", piped).otherwise(spoken)).alias("html"),
        label.alias("label"),
        F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
    )


def web_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The raw web pages, each with a labelled value and a month added behind its text."""
    key = F.col("page_id")
    label = text("Visits of page ", key, " (all)")
    return table(spark, sf, "pages").select(
        text("W", key).alias("symbol"),
        key.alias("pos"),
        F.col("url"),
        text(F.col("html"), "<p>", label, " stood\n at <b>", key, ",000.5</b> in May 2024</p>")
        .alias("html"),
        label.alias("label"),
        F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
    )


def price_table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per order with a piped price table that leads with the order day."""
    day = F.date_format("o_orderdate", "MMM d, yyyy")
    return table(spark, sf, "orders").select(
        text("O", F.col("o_orderkey")).alias("symbol"),
        F.col("o_orderkey").alias("pos"),
        text(
            "<h1>Order ", F.col("o_orderkey"), "</h1> Date | Price | Open <br> | --- | --- | ",
            day, " | ", F.format_number("o_totalprice", 2), " | ", F.col("o_orderkey"), " |",
        ).alias("html"),
        F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
    )


def supplier_months(spark: SparkSession, sf: str) -> DataFrame:
    """Largest quantity per supplier and ship month."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy/MM").alias("period"))
        .agg(F.max("l_quantity").alias("quantity"))
    )


def period_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per supplier with one table row per month; a quantity of 50 is shown as ND.

    The lines gathered on a page are one per month, however many line items there are.
    """
    shown = F.when(F.col("quantity") == 50, "ND").otherwise(F.col("quantity").cast("string"))
    line = text("<tr><td>", F.col("period"), "</td>\n<td>1</td><td>2</td><td>3</td><td>4</td><td>",
                shown, "</td></tr>")
    return (
        supplier_months(spark, sf)
        .groupBy("l_suppkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
        .select(
            text("S", F.col("l_suppkey")).alias("symbol"),
            F.col("l_suppkey").alias("pos"),
            F.concat(F.lit("<table>"), F.array_join("lines", "\n"), F.lit("</table>"))
            .alias("html"),
            F.lit(5).alias("position"),
            F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
        )
    )


def series_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV download per supplier: ship day and largest price, ``.`` where discounted by 10 %.

    The lines gathered in a body are one per day, however many line items there are.
    """
    series = text("S", F.col("l_suppkey"))
    shown = F.when(F.col("discount") >= 0.1, ".").otherwise(F.col("price").cast("string"))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.max("l_extendedprice").alias("price"), F.max("l_discount").alias("discount"))
        .groupBy("l_suppkey")
        .agg(F.sort_array(F.collect_list(text(F.col("day"), ",", shown))).alias("lines"))
        .select(
            series.alias("series_id"),
            F.concat(F.lit("observation_date, "), series, F.lit("\n"),
                     F.array_join("lines", "\n"), F.lit("\n")).alias("body"),
            F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
        )
    )


def raw_ohlcv(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under the raw column names, without an adjusted close."""
    return table(spark, sf, "orders").select(
        text("C", F.col("o_custkey")).alias("symbol"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_totalprice").alias("Open"),
        F.col("o_totalprice").alias("High"),
        F.col("o_totalprice").alias("Low"),
        F.col("o_totalprice").alias("Close"),
        F.col("o_orderkey").cast("double").alias("Volume"),
        F.lit("2024-06-30").cast("timestamp").alias("fetched_at"),
    )


def index_archives(spark: SparkSession, sf: str, suppliers: int = 100,
                   broken: bool = False) -> DataFrame:
    """The wide table as zipped CSV files ``(path, content)`` of so many suppliers each.

    With ``broken`` of every four archives the second is no zip file and the third has a header
    without months only.
    """
    wide = wide_table(spark, sf)
    own = [c for c in wide.columns if c != "file_row"]
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit('"')) for c in own]
    header = ",".join(own) + "\r\n"

    @F.pandas_udf("binary")
    def zipped(texts: pd.Series) -> pd.Series:
        def pack(text: str) -> bytes:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "index table")
                archive.writestr("INDEX.CSV", text.encode("cp932"))
            return buffer.getvalue()

        return texts.map(pack)

    lines = wide.select(
        F.expr(f"file_row div {suppliers}").alias("archive"),
        F.struct("file_row", F.concat_ws(",", *cells).alias("line")).alias("entry"))
    texts = lines.groupBy("archive").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    whole = F.concat(F.lit(header), F.array_join("entries.line", "\r\n"), F.lit("\r\n"))
    kind = F.when(F.lit(broken), F.col("archive") % 4).otherwise(0)
    return texts.select(
        F.format_string("archive-%012d.zip", "archive").alias("path"), kind.alias("kind"),
        F.when(kind == 2, ",".join(own[:4]) + "\r\n").otherwise(whole).alias("body"),
    ).select("path", F.when(F.col("kind") == 1, F.col("body").cast("binary")).otherwise(
        zipped("body")).alias("content"))


def wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """A wide string table: a row per supplier and return flag, a column per ship month.

    The months come from the first and last ship day, so only those two values reach the
    driver.
    """
    items = table(spark, sf, "lineitem")
    first, last = items.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    months = [
        f"{first.year + (first.month - 1 + i) // 12:04d}{(first.month - 1 + i) % 12 + 1:02d}"
        for i in range(count)
    ]
    series = F.when(F.col("l_returnflag") == "A", TARGETS[0]).when(
        F.col("l_returnflag") == "R", TARGETS[1]).otherwise(OTHER_SERIES)
    label = (
        F.when(F.col("s_nationkey") == 0, text("nation/総平均 ", F.col("s_name")))
        .when(F.col("s_nationkey") % 2 == 0, text("　N", F.col("s_nationkey"), "/__all /x "))
        .otherwise(text("N", F.col("s_nationkey")))
    )
    supplier = table(spark, sf, "supplier")
    return (
        items.withColumn("month", F.date_format("l_shipdate", "yyyyMM"))
        .groupBy("l_suppkey", "l_returnflag")
        .pivot("month", months)
        .agg(F.max("l_quantity"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            text("K", F.col("l_suppkey"), F.col("l_returnflag")).alias("id"),
            series.alias("name"),
            label.alias("label"),
            F.lit("unrelated").alias("note"),
            *[F.col(m).cast("string").alias(m) for m in months],
            F.col("l_suppkey").alias("file_row"),
        )
    )
