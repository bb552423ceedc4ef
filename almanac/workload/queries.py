"""One query per operator or composite of the survey, over the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from almanac.functions import pagetext as P
from almanac.functions.coerce import iso_day, to_day, to_number
from almanac.functions.display import delta_text, number_text
from almanac.functions.labels import classification
from almanac.operators import history as H
from almanac.operators.dedupe import keep_first
from almanac.operators.derived import combine_series, product_legs
from almanac.operators.enrich import align, enrich, flat_prices
from almanac.operators.snapshot import in_table_order, latest_snapshot
from almanac.operators.wide import in_index_order, melt_columns, name_ids, short_name, target_rows
from almanac.plans import dashboard as D
from almanac.plans.refresh import import_history, refresh_run
from almanac.plans.wide_index import index_from_archives, index_from_table, ingest_records
from almanac.schemas import CATALOG, INDEX_LITE_COLUMNS, LITE_COLUMNS
from almanac.sinks.csv import read_segments, write_csv, write_segments, write_yearly
from almanac.sinks.store import RUN_LOG, HistoryStore
from almanac.sources import catalog as C
from almanac.sources.archives import archive_rejects, unpack_archives
from almanac.sources.catalog import read_catalog
from almanac.sources.market import Landing, fetch
from almanac.sources.ohlcv import ohlcv_values
from almanac.sources.pages import labelled_hits, page_rows, period_hits, price_hits
from almanac.sources.series import series_values
from almanac.sources.tables import read_observations
from almanac.workload import adapters as A
from almanac.workload.positions import with_position
from almanac.workload.scratch import scratch_dir

RUN_AT = dt.datetime(2001, 8, 1)
OBSERVED = ["date", "symbol", "indicator_name", "category", "region", "refresh", "close"]
SNAPSHOT = OBSERVED + ["prev_close", "change", "change_pct"]
# The first load runs through OLD_LAST, the second one starts at NEW_FIRST: they overlap.
OLD_LAST, NEW_FIRST = "2024-01-20", "2024-01-11"


def _out(df: DataFrame, *columns: str) -> DataFrame:
    """Select, with the date in its ISO text form."""
    return df.select(*[iso_day(c).alias(c) if c == "date" else F.col(c) for c in columns])


def _unique_events(spark: SparkSession, sf: str) -> DataFrame:
    return H.latest_arrivals(A.event_observations(spark, sf))


def snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = latest_snapshot(_unique_events(spark, sf))
    return _out(in_table_order(rows), *SNAPSHOT)


def snapshot_by_name_query(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols that change their name with the event, ordered by name before date."""
    renamed = A.text(F.col("symbol"), "/", F.col("seq") % 3)
    rows = _unique_events(spark, sf).withColumn("indicator_name", renamed)
    return _out(latest_snapshot(rows, name_first=True), *SNAPSHOT)


def headline_query(spark: SparkSession, sf: str) -> DataFrame:
    return D.headline(D.latest_rows(_unique_events(spark, sf), D.Selection()))


def dedupe_last_query(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_unique_events(spark, sf), *OBSERVED, "seq")


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping loads of the events; the second one brings revised values."""
    rows = A.event_observations(spark, sf)
    old = rows.where(F.col("date") <= F.lit(OLD_LAST).cast("date"))
    new = rows.where(F.col("date") >= F.lit(NEW_FIRST).cast("date"))
    return old, new.withColumn("close", F.col("close") + 1000)


def upsert_query(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _loads(spark, sf)
    return _out(H.upsert(old, new), *OBSERVED)


def lite_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.lite(A.order_observations(spark, sf), A.ORDER_FLOOR)
    return _out(H.in_name_order(rows), *rows.columns)


def segment_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.segments(A.order_observations(spark, sf), A.ORDER_FLOOR)
    return rows.groupBy("refresh", "year").agg(
        F.count(F.lit(1)).alias("rows"),
        iso_day(F.min("date")).alias("first_date"),
        iso_day(F.max("date")).alias("last_date"),
    )


def active_query(spark: SparkSession, sf: str) -> DataFrame:
    active = H.active_symbols(A.customer_catalog(spark, sf))
    rows = H.keep_active(A.customer_series(spark, sf), active)
    return _out(rows, "symbol", "date", "close", "seq")


def enrich_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = flat_prices(A.customer_series(spark, sf))
    rows = enrich(raw, A.customer_catalog(spark, sf))
    return _out(rows, *OBSERVED, "open", "adj_close", "volume", "source", "unit", "seq")


def by_refresh_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.by_refresh(A.customer_catalog(spark, sf), "daily")
    return rows.select("symbol", "name", "refresh", "pos")


def product_query(spark: SparkSession, sf: str) -> DataFrame:
    """Per user: the day's last click value times the day's last view value."""
    series = A.event_observations(spark, sf).withColumnRenamed("symbol", "series_id")
    user = F.col("user_id")
    entries = A.catalog_rows(
        A.table(spark, sf, "events").select("user_id").distinct(),
        symbol=A.text("D", user),
        source_type=F.lit(C.DERIVED),
        formula=F.lit("multiply"),
        series_ids=F.array(A.text("click_", user), A.text("view_", user)),
        pos=user,
    )
    rows = flat_prices(combine_series(series, product_legs(entries)))
    return _out(rows, "symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


def melt_query(spark: SparkSession, sf: str) -> DataFrame:
    wide = name_ids(A.wide_table(spark, sf), ("file_row",))
    long = melt_columns(wide).withColumn("close", to_number("close"))
    return long.dropna(subset=["close"])


def target_query(spark: SparkSession, sf: str) -> DataFrame:
    wide = target_rows(name_ids(A.wide_table(spark, sf), ("file_row",)))
    return wide.select("code", "label_raw", short_name().alias("indicator_name"))


def tidy_index_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = index_from_table(A.wide_table(spark, sf), ["file_row"])
    return _out(in_index_order(rows), *rows.columns)


def dedupe_first_query(spark: SparkSession, sf: str) -> DataFrame:
    """First line item per part and ship day."""
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    rows = A.table(spark, sf, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("date"), *order)
    return _out(keep_first(rows, ["l_partkey", "date"], order), "l_partkey", "date", *order)


def page_text_query(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "pages").select("page_id", P.page_text("html").alias("text"))


def _one_value(rows: DataFrame) -> DataFrame:
    return _out(flat_prices(rows), "symbol", "date", "open", "close", "volume")


def labelled_query(spark: SparkSession, sf: str) -> DataFrame:
    return _one_value(page_rows(A.part_pages(spark, sf), labelled_hits())[0])


def web_labelled_query(spark: SparkSession, sf: str) -> DataFrame:
    return _one_value(page_rows(A.web_pages(spark, sf), labelled_hits())[0])


def page_rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    """Part pages whose first ``in <word> <year>`` names a colour or size instead of a month."""
    word = F.split("p_name", " ")[0]
    early = F.when(F.col("p_type") == "PROMO", A.text("<i>in ", word, " 2023</i> ")).otherwise("")
    return page_rows(A.part_pages(spark, sf, early), labelled_hits())[1]


def month_query(spark: SparkSession, sf: str) -> DataFrame:
    found = P.month_reference(P.page_text("html"))
    rows = A.part_pages(spark, sf).select("symbol", F.inline(F.array(found)))
    return rows.select("symbol", iso_day("day").alias("month"), F.col("bad").alias("rejected"))


def period_query(spark: SparkSession, sf: str) -> DataFrame:
    return _one_value(page_rows(A.period_pages(spark, sf), period_hits())[0])


def price_table_query(spark: SparkSession, sf: str) -> DataFrame:
    return _one_value(page_rows(A.price_table_pages(spark, sf), price_hits())[0])


def series_query(spark: SparkSession, sf: str) -> DataFrame:
    return _out(series_values(A.series_bodies(spark, sf)), "series_id", "date", "close", "row")


def ohlcv_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = ohlcv_values(A.raw_ohlcv(spark, sf), RUN_AT.date())
    return _out(rows, "symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


def _variants(df: DataFrame, keys: list[str], raw: list[Column]) -> DataFrame:
    return df.select(*keys, F.posexplode(F.array(*raw)).alias("variant", "raw"))


def numbers_query(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value").cast("string")
    raw = [
        value, A.text("  ", value, " "), A.text(value, "d"), A.text("1,", value),
        F.col("props"), F.col("event_type"), F.lit("."), F.lit(""), A.text("0x", F.col("user_id")),
        A.text("+", F.col("user_id"), "e2"), F.lit("nan"),
    ]
    rows = _variants(A.table(spark, sf, "events"), ["event_id"], raw)
    return rows.select("event_id", "variant", to_number("raw").alias("number"))


def dates_query(spark: SparkSession, sf: str) -> DataFrame:
    def shown(pattern: str) -> Column:
        return F.date_format("o_orderdate", pattern)

    raw = [
        shown("yyyy-MM-dd"), shown("yyyy/MM/dd"), shown("yyyy-MM-dd HH:mm:ss"), shown("yyyy"),
        shown("yyyy-MM/dd"), F.col("o_orderpriority"), F.lit(""), A.text(shown("yyyy"), "-02-30"),
    ]
    rows = _variants(A.table(spark, sf, "orders"), ["o_orderkey"], raw)
    day = to_day("raw")
    return rows.select(
        "o_orderkey", "variant", iso_day(day).alias("day"), F.year(day).alias("year"))


def display_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "lineitem")
    delta = (F.col("l_discount") - F.col("l_tax")) * F.col("l_quantity")
    return rows.select(
        "l_orderkey", "l_linenumber",
        number_text("l_extendedprice").alias("price_text"),
        number_text("l_quantity").alias("quantity_text"),
        delta_text(delta).alias("delta_text"),
    )


def labels_query(spark: SparkSession, sf: str) -> DataFrame:
    parts = A.table(spark, sf, "part").select(
        A.text("p", F.col("p_partkey")).alias("id"),
        F.when(F.col("p_type") == "PROMO", A.text(F.col("p_brand"), "/総平均"))
        .when(F.col("p_type") == "LARGE", A.text("　", F.col("p_name"), " "))
        .otherwise(A.text(F.col("p_type"), " /__ ", F.col("p_brand"), " /", F.col("p_name"), "　"))
        .alias("label"),
    )
    urls = A.table(spark, sf, "pages").select(
        A.text("u", F.col("page_id")).alias("id"), F.col("url").alias("label"))
    level1, level2 = classification("label")
    return parts.unionByName(urls).select(
        "id", level1.alias("classification1"), level2.alias("classification2"))


def facet_query(spark: SparkSession, sf: str) -> DataFrame:
    return D.facet_values(D.dataset(A.order_observations(spark, sf)))


def extent_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.date_extent(D.dataset(A.order_observations(spark, sf)))
    return rows.select(*[iso_day(c).alias(c) for c in rows.columns])


SELECTION = D.Selection(
    refresh=["daily"], category=["BUILDING", "MACHINERY"], region=["ASIA", "EUROPE", "AFRICA"])


def trend_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.trend(
        D.dataset(A.order_observations(spark, sf)), SELECTION, "1997-03-01", "1999-09-30")
    return _out(rows, "indicator_name", "symbol", "date", "close")


EVENT_SELECTION = D.Selection(category=["click", "purchase"], region=["R1", "R2", "R3"])


def latest_slice_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.latest_table(_unique_events(spark, sf), EVENT_SELECTION)
    return _out(rows, *rows.columns)


EVENT_RUN_AT = dt.datetime(2024, 2, 15)


def _event_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """An OHLCV entry per event type and user; some users' entries lack a name."""
    user = F.col("user_id")
    users = A.table(spark, sf, "events").groupBy("event_type", "user_id").agg(
        F.min("event_id").alias("first"))
    symbol = A.text(F.col("event_type"), "_", user)
    return A.catalog_rows(
        users, symbol=symbol, name=F.when(user % 7 != 3, symbol), category=F.col("event_type"),
        region=A.text("R", user % 5), refresh=F.when(user % 10 == 0, "monthly").otherwise("daily"),
        source=F.lit("events"), source_type=F.lit(C.OHLCV), unit=F.lit(""), pos=F.col("first"))


def _ohlcv_landing(load: DataFrame) -> Landing:
    """Events as OHLCV rows; of a day's events the one with the last id is the latest."""
    moment = F.timestamp_micros(F.unix_micros(F.col("date").cast("timestamp")) + F.col("seq"))
    return Landing(ohlcv=load.select(
        "symbol", moment.alias("Date"), F.col("close").alias("Close"),
        F.lit(EVENT_RUN_AT).alias("fetched_at")))


def _event_run(spark: SparkSession, sf: str) -> tuple[HistoryStore, Row]:
    """Two published runs over the two loads of events, the second one with exports.

    Only users with a click are in the second run's catalog. Of a day's events the last id counts.
    """
    catalog = _event_catalog(spark, sf)
    clicked = A.table(spark, sf, "events").where("event_type = 'click'").select(
        F.col("user_id").alias("u")).distinct()
    fewer = catalog.join(
        clicked, F.substring_index("symbol", "_", -1) == F.col("u").cast("string"), "left_semi")
    store = HistoryStore(spark, scratch_dir(spark, "events"))
    exports = scratch_dir(spark, "event-exports")
    for entries, load, out in zip((catalog, fewer), _loads(spark, sf), (None, exports)):
        run = refresh_run(store, entries, _ohlcv_landing(load), EVENT_RUN_AT, exports=out)
    return store, run


def import_query(spark: SparkSession, sf: str) -> DataFrame:
    """The first load as a history file, imported into a store, and the second one as its next run."""
    old, new = _loads(spark, sf)
    path = scratch_dir(spark, "old-history")
    rows = align(H.latest_arrivals(old))
    write_csv(rows, path, H.name_order(rows))
    store = HistoryStore(spark, scratch_dir(spark, "imported"))
    import_history(store, read_observations(spark, path), EVENT_RUN_AT)
    run = refresh_run(store, _event_catalog(spark, sf), _ohlcv_landing(new), EVENT_RUN_AT)
    return _out(store.read(store.years(run)), *OBSERVED)


def refresh_query(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot that a run wrote as CSV."""
    _, run = _event_run(spark, sf)
    path = f"{run['exports']}/latest_snapshot/version={run['version']}"
    numbers = ["close", "prev_close", "change", "change_pct"]
    rows = spark.read.option("header", True).csv(path)
    return rows.select(*[to_number(c).alias(c) if c in numbers else F.col(c) for c in SNAPSHOT])


def metrics_query(spark: SparkSession, sf: str) -> DataFrame:
    """What the run observed, from its row in the run log."""
    store, run = _event_run(spark, sf)
    log = spark.read.schema(RUN_LOG).json(f"{store.path}/runs")
    return log.where(F.col("version") == run["version"]).select(
        F.explode("metrics").alias("metric", "rows"))


def rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    store, run = _event_run(spark, sf)
    return spark.read.parquet(f"{store.path}/rejects/version={run['version']}")


def exports_query(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the segment files and of the history files, with the file's kind."""
    _, run = _event_run(spark, sf)
    held = {int(y): v for y, v in run["exported"].items()}
    rows = read_segments(spark, f"{run['exports']}/segments", held).select(
        F.concat_ws("_", F.lit("segment"), "cadence", "year").alias("file"), *LITE_COLUMNS)
    for name in ("history", "history_lite"):
        whole = spark.read.option("header", True).csv(
            f"{run['exports']}/{name}/version={run['version']}")
        rows = rows.unionByName(whole.select(F.lit(name).alias("file"), *LITE_COLUMNS))
    return rows.withColumn("close", to_number("close"))


def _all_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, Landing]:
    """A catalog with every source type, and landed downloads for it."""
    about = {"category": F.lit("cat"), "region": F.lit("reg"), "refresh": F.lit("daily")}
    part, supplier, order = F.col("p_partkey"), F.col("s_suppkey"), F.col("o_orderkey")
    customer = F.col("c_custkey")
    suppliers = A.table(spark, sf, "supplier")
    marks = "FSPOCXU"

    def entries(df: DataFrame, key: Column, mark: str, kind: str, **more: Column) -> DataFrame:
        columns = {
            "symbol": A.text(mark, key), "name": A.text(kind, " ", key), "source": F.lit(kind),
            "source_type": F.lit(kind), "pos": key * len(marks) + marks.index(mark),
            **about, **more,
        }
        return A.catalog_rows(df, **columns)

    catalog = H.union_sources([
        entries(suppliers, supplier, "F", C.SERIES, series_id=A.text("S", supplier)),
        entries(suppliers, supplier, "S", C.PERIOD_PAGE, series_position=F.lit(5)),
        entries(A.table(spark, sf, "part"), part, "P", C.LABELLED_PAGE,
                page_label=A.text("Retail price of part ", part)),
        entries(A.table(spark, sf, "orders"), order, "O", C.PRICE_PAGE),
        entries(A.table(spark, sf, "customer"), customer, "C", C.OHLCV),
        entries(suppliers, supplier, "X", C.DERIVED, formula=F.lit("multiply"),
                series_ids=F.array(A.text("S", supplier), A.text("S", supplier + 1))),
        entries(suppliers, supplier, "U", "unheard of"),
    ])
    pages = H.union_sources([
        df.select("symbol", F.lit(None).cast("string").alias("url"), "html", "fetched_at")
        for df in (A.period_pages(spark, sf), A.part_pages(spark, sf),
                   A.price_table_pages(spark, sf))
    ])
    # The raw orders of a customer may share a day; the largest order key counts as the last.
    ohlcv = A.raw_ohlcv(spark, sf).withColumn(
        "Date", F.col("Date").cast("timestamp")
        + F.make_dt_interval(secs=(F.col("Volume") / 1_000_000).cast("decimal(18,6)")))
    return catalog, Landing(series=A.series_bodies(spark, sf), ohlcv=ohlcv, pages=pages)


def _fetched(rows: DataFrame) -> DataFrame:
    shown = rows.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))
    return _out(shown, "symbol", "date", "open", "close", "volume", "indicator_name", "category",
                "region", "refresh", "source", "unit", "fetched_at")


def fetch_query(spark: SparkSession, sf: str) -> DataFrame:
    """Every source type at once: series, OHLCV rows and three kinds of pages."""
    catalog, landing = _all_sources(spark, sf)
    rows = fetch(catalog, landing, RUN_AT, floor=A.ORDER_FLOOR).observations
    return _fetched(rows)


def archive_query(spark: SparkSession, sf: str) -> DataFrame:
    records = unpack_archives(A.index_archives(spark, sf))
    rows = index_from_archives(records)
    return _out(rows, *rows.columns)


def index_exports_query(spark: SparkSession, sf: str) -> DataFrame:
    """The whole ingest; each of its four exports read back under its name."""
    out = scratch_dir(spark, "index")
    ingest_records(unpack_archives(A.index_archives(spark, sf)), out)
    frames = []
    for name, sep in (("index_csv", ","), ("index_tsv", "\t"), ("yearly", ","),
                      ("yearly_lite", ",")):
        rows = spark.read.options(header=True, sep=sep).csv(f"{out}/{name}")
        frames.append(rows.select(F.lit(name).alias("file"), *INDEX_LITE_COLUMNS))
    rows = H.union_sources(frames)
    return rows.withColumns({
        "close": to_number("close"), "classification2": F.coalesce("classification2", F.lit(""))})


def archive_rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of two suppliers, of which some are no zip files or have no months."""
    return archive_rejects(unpack_archives(A.index_archives(spark, sf, 2, broken=True)))


ENTRIES_PER_FILE = 10_000


def catalog_file_query(spark: SparkSession, sf: str) -> DataFrame:
    """The customer catalog written as a JSON array and read back, with its file order."""
    path = scratch_dir(spark, "catalog")
    rows = A.customer_catalog(spark, sf)
    entry = F.to_json(F.struct(*CATALOG.names))
    # 25 parts, each of arrays of a bounded number of entries, as files in the order of their names.
    block = F.floor(F.col("pos") / (25 * ENTRIES_PER_FILE))
    arrays = rows.groupBy((F.col("pos") % 25).alias("part"), block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", entry.alias("entry")))).alias("entries"))
    text = F.concat(F.lit("[\n"), F.array_join("entries.entry", ",\n"), F.lit("\n]"))
    arrays.select(
        F.format_string("%02d", "part").alias("part"),
        F.format_string("%012d", "block").alias("block"), text.alias("value"),
    ).write.option("lineSep", "\n").partitionBy("part", "block").text(path)
    read = read_catalog(spark, path)
    place = F.row_number().over(Window.partitionBy("part").orderBy("pos"))
    return read.select("symbol", "name", "category", "region", "refresh", "unit",
                       F.col("part").cast("long").alias("file"), place.alias("place"))


def ordered_dataset_query(spark: SparkSession, sf: str) -> DataFrame:
    """The dashboard's dataset by name, each row with its position."""
    rows = H.lite(D.dataset(A.order_observations(spark, sf)), "1900-01-01")
    return _out(with_position(H.in_name_order(rows)), "position", *LITE_COLUMNS)


def ordered_snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_table_order(latest_snapshot(_unique_events(spark, sf)))
    return _out(with_position(rows), "position", "refresh", "category", "region", "symbol", "close")


def ordered_index_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_index_order(index_from_table(A.wide_table(spark, sf), ["file_row"]))
    return _out(with_position(rows), "position", *INDEX_LITE_COLUMNS, "code")


def csv_query(spark: SparkSession, sf: str) -> DataFrame:
    """Observations written as CSV with a byte order mark and read back."""
    path = scratch_dir(spark, "observations")
    rows = _unique_events(spark, sf)
    write_csv(align(rows), path, H.name_order(rows))
    return _out(read_observations(spark, path), *OBSERVED)


def segment_files_query(spark: SparkSession, sf: str) -> DataFrame:
    """Lite rows written by cadence and year and read back; the floor leaves out early days."""
    path = scratch_dir(spark, "segments")
    write_segments(A.order_observations(spark, sf), path, floor=A.ORDER_FLOOR)
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        "cadence", "year", *[F.col(c) for c in LITE_COLUMNS if c != "close"],
        to_number("close").alias("close"))


def yearly_files_query(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows written by year, in full and lite form, and joined again."""
    full, short = scratch_dir(spark, "yearly"), scratch_dir(spark, "yearly_lite")
    path = scratch_dir(spark, "index-table")
    index_from_table(A.wide_table(spark, sf), ["file_row"]).write.parquet(path)
    write_yearly(spark.read.parquet(path), full, short)
    rows = spark.read.option("header", True).csv(full)
    keys = [*INDEX_LITE_COLUMNS, "year"]
    light = spark.read.option("header", True).csv(short).select(*keys)
    light = light.withColumnsRenamed({c: f"lite_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"lite_{c}")) for c in keys]
    both = rows.join(light, reduce(lambda a, b: a & b, same))
    return both.select(
        "date", "indicator_name", "classification1",
        F.coalesce("classification2", F.lit("")).alias("classification2"),
        to_number("close").alias("close"), "code", "label_raw", "year")


def store_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two published runs: series and pages first, then OHLCV rows and the pages once more."""
    catalog, landing = _all_sources(spark, sf)
    store = HistoryStore(spark, scratch_dir(spark, "store"))
    for part in (Landing(series=landing.series, pages=landing.pages),
                 Landing(ohlcv=landing.ohlcv, pages=landing.pages)):
        run = refresh_run(store, catalog, part, RUN_AT, floor=A.ORDER_FLOOR)
    return _fetched(store.read(store.years(run)))


QUERIES = {
    "latest_snapshot": snapshot_query,
    "latest_snapshot_by_name": snapshot_by_name_query,
    "headline_topk": headline_query,
    "dedupe_keep_last": dedupe_last_query,
    "dedupe_keep_first": dedupe_first_query,
    "upsert_history": upsert_query,
    "history_lite": lite_query,
    "segment_counts": segment_query,
    "active_symbols": active_query,
    "catalog_by_refresh": by_refresh_query,
    "enrich_catalog": enrich_query,
    "derived_product": product_query,
    "wide_to_long": melt_query,
    "target_series": target_query,
    "wide_index_tidy": tidy_index_query,
    "split_labels": labels_query,
    "page_text": page_text_query,
    "labelled_value": labelled_query,
    "labelled_value_web": web_labelled_query,
    "page_rejects": page_rejects_query,
    "month_reference": month_query,
    "period_table": period_query,
    "price_table": price_table_query,
    "series_normalise": series_query,
    "ohlcv_normalise": ohlcv_query,
    "coerce_numbers": numbers_query,
    "coerce_dates": dates_query,
    "display_text": display_query,
    "facet_values": facet_query,
    "date_extent": extent_query,
    "trend_slice": trend_query,
    "latest_slice": latest_slice_query,
    "fetch_observations": fetch_query,
    "archive_ingest": archive_query,
    "csv_round_trip": csv_query,
    "segment_files": segment_files_query,
    "yearly_files": yearly_files_query,
    "store_runs": store_query,
    "refresh_run": refresh_query,
    "imported_history": import_query,
    "run_metrics": metrics_query,
    "run_rejects": rejects_query,
    "run_exports": exports_query,
    "index_exports": index_exports_query,
    "archive_rejects": archive_rejects_query,
    "catalog_file": catalog_file_query,
    "ordered_dataset": ordered_dataset_query,
    "ordered_snapshot": ordered_snapshot_query,
    "ordered_index": ordered_index_query,
}
