import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from almanac.operators import history as H
from almanac.operators.dedupe import keep_first, keep_last, key_hash
from almanac.operators.derived import combine_series, direct_legs, product_legs
from almanac.operators.enrich import align, enrich, flat_prices
from almanac.operators.joins import fits_broadcast, lookup_join
from almanac.operators.snapshot import in_table_order, latest_snapshot
from almanac.schemas import LITE_COLUMNS, OBSERVATION, OBSERVATION_COLUMNS
from almanac.workload.adapters import catalog_rows

DAY = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_and_first(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 3, 30), ("a", 2, 20), (None, 1, 5), (None, 2, 6), ("b", None, 7)],
        "k string, seq int, v int")
    assert values(keep_last(df, ["k"], ["seq"]), "k", "v") == [("a", 30), ("b", 7), (None, 6)]
    assert values(keep_first(df, ["k"], ["seq"]), "k", "v") == [("a", 10), ("b", 7), (None, 5)]


def test_dedupe_limits_rows_before_the_exchange(spark, observations):
    plan = plan_of(keep_last(observations([("a", "2026-01-01", 1.0, 1)]), H.KEY, ["seq"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_rows_of_a_symbol_are_neighbours_in_the_order_of_their_hash(spark):
    days = spark.range(50).select(F.expr("date_add(date'2026-01-01', cast(id as int))").alias("date"))
    names = spark.range(40).select(F.when(F.col("id") > 0, F.concat(F.lit("s"), "id")).alias("symbol"))
    ordered = [r["symbol"] for r in names.crossJoin(days).orderBy(key_hash(H.KEY)).collect()]
    assert sum(a != b for a, b in zip(ordered, ordered[1:])) == 39
    assert names.crossJoin(days).select(key_hash(H.KEY)).distinct().count() == 2000


def test_hot_group_of_copies_ships_one_row_per_task(spark):
    rows = spark.range(0, 60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("k"), F.col("id").alias("seq"))
    out = keep_last(rows, ["k"], ["seq"])
    assert out.count() == 40_001
    assert out.where("k = 'hot'").first()["seq"] == 59_997


# --- joins -------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    fact = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("symbol"),
        F.col("id").alias("seq"))
    lookup = spark.range(0, 600).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("symbol"), F.col("id").alias("meta"))
    return fact, lookup


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_lookup_join_gives_the_same_rows_either_way(skewed, how):
    fact, lookup = skewed
    plain = fact.join(lookup, "symbol", how)
    for small in (True, False):
        joined = lookup_join(fact, lookup, "symbol", how, small)
        assert joined.columns == plain.columns
        assert values(joined, *plain.columns) == values(plain, *plain.columns)


def test_broadcast_is_measured(spark, skewed):
    _, lookup = skewed
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=599)
    assert not fits_broadcast(lookup, max_bytes=1_000)
    assert fits_broadcast(lookup.limit(0), max_rows=0)
    nested = spark.createDataFrame([(["a" * 100, "b"], None)], "a array<string>, s string")
    assert fits_broadcast(nested, max_bytes=200) and not fits_broadcast(nested, max_bytes=100)


# --- enrichment --------------------------------------------------------------------------


def catalog(spark, rows):
    df = spark.createDataFrame(rows, "s string, n string, r string, u string, p int")
    return catalog_rows(df, symbol=F.col("s"), name=F.col("n"), category=F.lit("FX"),
                        region=F.lit("Global"), source=F.lit("src"), refresh=F.col("r"),
                        unit=F.col("u"), pos=F.col("p"))


def test_enrich_and_align(spark):
    raw = spark.createDataFrame([("A", DAY(2026, 1, 2), 5.0, 1), ("B", DAY(2026, 1, 2), 6.0, 2),
                                 ("Z", DAY(2026, 1, 2), 7.0, 3)],
                                "symbol string, date date, close double, seq int")
    entries = catalog(spark, [("A", "a", "daily", None, 0), ("B", "b", None, "USD", 1)])
    rows = enrich(flat_prices(raw), entries)
    assert rows.columns == OBSERVATION_COLUMNS + ["seq"]
    assert values(rows, "symbol", "indicator_name", "refresh", "unit", "open", "volume", "seq") == [
        ("A", "a", "daily", "", 5.0, None, 1), ("B", "b", "", "USD", 6.0, None, 2)]
    spread = enrich(flat_prices(raw), entries, small=True)
    assert values(spread, *rows.columns) == values(rows, *rows.columns)
    assert enrich(raw, entries).first()["high"] is None
    assert align(raw.withColumn("extra", F.lit(1))).schema.names == OBSERVATION.names


# --- history -----------------------------------------------------------------------------


def test_upsert(observations):
    old = observations([
        ("A", "2026-01-01", 1.0, 1), ("A", "2026-01-01", 1.5, 2), ("A", "2026-01-02", 2.0, 9),
        ("B", "2019-12-31", 9.0, 4), ("C", None, 9.0, 5), (None, "2026-01-01", 3.0, 6)])
    new = observations([
        ("A", "2026-01-02", 2.5, 1), ("A", "2026-01-03", None, 2), ("A", "2026-01-01", None, 1),
        (None, "2026-01-01", 4.0, 1)])
    want = [("A", DAY(2026, 1, 1), None), ("A", DAY(2026, 1, 2), 2.5),
            ("A", DAY(2026, 1, 3), None), (None, DAY(2026, 1, 1), 4.0)]
    merged = H.upsert(old, new)
    assert merged.columns == OBSERVATION_COLUMNS
    assert values(merged, "symbol", "date", "close") == want
    again = H.upsert(merged, new)
    assert values(again, *OBSERVATION_COLUMNS) == values(merged, *OBSERVATION_COLUMNS)


def test_upsert_cleans_even_against_an_empty_side(spark, observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("A", "2026-01-01", 2.0, 2),
                         ("A", "2019-01-01", 3.0, 3)])
    empty = spark.createDataFrame([], OBSERVATION)
    for merged in (H.upsert(empty, rows), H.upsert(rows, empty)):
        assert values(merged, "symbol", "close") == [("A", 2.0)]


def test_upsert_takes_text_columns(spark, observations):
    old = spark.createDataFrame([("A", "2026/01/01", "1"), ("A", "x", "1"), ("B", "2026-01-01", "ND")],
                                "symbol string, date string, close string")
    merged = H.upsert(old, observations([("A", "2026-01-02", 2.0, 1)]))
    assert values(merged, "symbol", "date", "close") == [
        ("A", DAY(2026, 1, 1), 1.0), ("A", DAY(2026, 1, 2), 2.0), ("B", DAY(2026, 1, 1), None)]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_results_do_not_depend_on_partitioning(spark, observations, parts):
    rows = [(f"S{i % 7}", f"2026-01-{i % 11 + 1:02d}", float(i * 37 % 101), i) for i in range(400)]
    df = observations(rows)
    base = values(latest_snapshot(H.latest_arrivals(df)), "symbol", "close", "prev_close")
    moved = df.repartition(parts, "close")
    assert values(latest_snapshot(H.latest_arrivals(moved)),
                  "symbol", "close", "prev_close") == base
    assert len(base) == 7


def test_active_symbols(spark, observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("B", "2026-01-01", 1.0, 2),
                         (None, "2026-01-01", 1.0, 3), ("", "2026-01-01", 1.0, 4)])
    entries = catalog(spark, [("A", "a", None, None, 0), ("", "b", None, None, 1),
                              (None, "c", None, None, 2), ("A", "d", None, None, 3)])
    active = H.active_symbols(entries)
    assert values(active, "symbol") == [("A",)]
    for small in (True, False):
        assert values(H.keep_active(rows, active, small), "symbol") == [("A",)]
        assert H.keep_active(rows, active.limit(0), small).count() == 0
        both = H.upsert_active(rows, rows.limit(0), active, small=small)
        assert values(both, "symbol") == [("A",)]


def test_lite_keeps_copies_and_drops_incomplete_rows(observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("A", "2026-01-01", 1.0, 2),
                         ("A", "2026-01-02", None, 3), ("A", None, 1.0, 4), (None, "2026-01-01", 1.0, 5),
                         ("A", "2019-12-31", 1.0, 6), ("A", "2026-01-03", float("nan"), 7)])
    assert H.lite(rows).columns == LITE_COLUMNS
    assert values(H.lite(rows), "indicator_name", "close") == [("A", 1.0), ("A", 1.0)]
    assert H.lite(rows.drop("region")).where("region is null").count() == 2


def test_segments(observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("B", "2025-01-01", 2.0, 2),
                         ("C", "2026-01-01", 3.0, 3)])
    rows = rows.withColumn("refresh", F.when(F.col("symbol") == "C", "weekly").when(
        F.col("symbol") == "B", "monthly").otherwise("daily"))
    assert values(H.segments(rows), "refresh", "year", "close") == [
        ("daily", 2026, 1.0), ("monthly", 2025, 2.0)]


def test_name_order_puts_nulls_last(observations):
    rows = observations([(None, "2026-01-01", 1.0, 1), ("b", None, 2.0, 2), ("b", "2026-01-01", 3.0, 3),
                         ("B", "2026-01-01", 4.0, 4)])
    got = [r["close"] for r in H.in_name_order(rows).collect()]
    assert got == [4.0, 3.0, 2.0, 1.0]


# --- derived series ----------------------------------------------------------------------


def legs(spark, entries):
    df = spark.createDataFrame(entries, "s string, f string, ids array<string>, p int")
    return product_legs(catalog_rows(df, symbol=F.col("s"), formula=F.col("f"),
                                     series_ids=F.col("ids"), pos=F.col("p")))


def test_combine_series(spark, observations):
    series = observations([
        ("X", "2026-01-01", 2.0, 1), ("X", "2026-01-01", 3.0, 2), ("X", "2026-01-02", 5.0, 3),
        ("X", "2026-01-04", None, 3), ("Y", "2026-01-01", 10.0, 4), ("Y", "2026-01-01", 20.0, 5),
        ("Y", "2026-01-03", 7.0, 6), ("Y", "2026-01-04", 7.0, 6),
    ]).withColumnRenamed("symbol", "series_id")
    inputs = legs(spark, [
        ("XY", "multiply", ["X", "Y"], 0), ("XX", "multiply", ["X", "X"], 1),
        ("SUM", "add", ["X", "Y"], 2), ("ONE", "multiply", ["X"], 3),
        ("THREE", "multiply", ["X", "Y", "X"], 4), ("GONE", "multiply", ["X", "W"], 5),
        ("NONE", None, None, 6),
    ])
    want = [("XX", DAY(2026, 1, 1), 9.0), ("XX", DAY(2026, 1, 2), 25.0),
            ("XY", DAY(2026, 1, 1), 60.0)]
    for small in (True, False):
        got = combine_series(series, inputs, small)
        assert values(got, "symbol", "date", "close") == want


def test_direct_series(spark, observations):
    series = observations([("X", "2026-01-01", 2.0, 1), ("X", "2026-01-01", 3.0, 2),
                           ("X", "2026-01-02", None, 1), ("Y", "2026-01-01", 4.0, 1)])
    df = spark.createDataFrame([("A", "X", 0), ("B", "X", 1), ("C", None, 2)], "s string, i string, p int")
    entries = catalog_rows(df, symbol=F.col("s"), series_id=F.col("i"), pos=F.col("p"))
    got = combine_series(series.withColumnRenamed("symbol", "series_id"), direct_legs(entries))
    assert values(got, "symbol", "pos", "close") == [("A", 0, 3.0), ("B", 1, 3.0)]


def test_combined_days_are_sorted_by_a_number_first(spark, observations):
    entries = spark.createDataFrame([("A", 0, "A")], "symbol string, pos bigint, series_id string")
    series = observations([("A", "2026-01-05", 1.0, 0), ("A", "2026-01-05", 2.0, 1),
                           ("A", "2026-01-06", 3.0, 0)])
    series = series.withColumnRenamed("symbol", "series_id").withColumn("seq", F.struct("seq"))
    got = combine_series(series, direct_legs(entries))
    assert values(got, "symbol", "date", "close") == [
        ("A", DAY(2026, 1, 5), 2.0), ("A", DAY(2026, 1, 6), 3.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    sorts = [line.split("Sort [")[1] for line in plan.splitlines() if "Sort [" in line]
    grouped = [s for s in sorts if not s.startswith("series_id")]
    assert grouped and all(s.startswith(("hash(", "_groupingexpression")) for s in grouped)


def test_product_is_bit_exact(spark, observations):
    # --- fixed values: two days of published input and output closes
    usdjpy = {"2026-01-02": 156.82, "2026-05-15": 158.69}
    eurusd = {"2026-01-02": 1.17305, "2026-05-15": 1.1627}
    rows = [("L", d, v, 1) for d, v in usdjpy.items()] + [("R", d, v, 2) for d, v in eurusd.items()]
    got = combine_series(observations(rows).withColumnRenamed("symbol", "series_id"),
                          legs(spark, [("P", "multiply", ["L", "R"], 0)]))
    assert values(got, "close") == sorted([(usdjpy[d] * eurusd[d],) for d in usdjpy], key=repr)
    assert (184.50886300000002,) in values(got, "close")


# --- snapshot ----------------------------------------------------------------------------


def test_snapshot_reproduces_published_rows(observations):
    # --- fixed values: last two closes of five series and the published result
    published = [
        ("WTI Crude Oil", "2026-05-18", 112.25, 108.99, 3.260000000000005, 2.9911001009266953),
        ("EUR/JPY", "2026-05-15", 184.50886300000002, 184.605824, -0.09696099999999319,
         -0.052523261671307386),
        ("EUR/USD", "2026-05-15", 1.1627, 1.1678, -0.005099999999999882, -0.43671861620139435),
        ("USD/JPY", "2026-05-15", 158.69, 158.08, 0.6099999999999852, 0.3858805668016101),
        ("Semiconductor Index (SOX)", "2026-05-19", 11305.5, 11302.52, 2.9799999999995634,
         0.02636580160884089),
    ]
    rows = []
    for name, day, close, prev, *_ in published:
        rows += [(name, day, close, 3), (name, "2026-05-14", prev, 2), (name, "2026-05-13", 1.0, 1)]
    got = latest_snapshot(observations(rows)).withColumn("date", F.col("date").cast("string"))
    assert values(got, "symbol", "date", "close", "prev_close", "change", "change_pct") == sorted(
        published, key=repr)


def test_snapshot_edges(observations):
    rows = observations([
        ("one", "2026-01-01", 5.0, 1),
        ("zero", "2026-01-01", 0.0, 1), ("zero", "2026-01-02", 5.0, 2),
        ("hole", "2026-01-01", 4.0, 1), ("hole", "2026-01-02", None, 2), ("hole", "2026-01-03", 6.0, 3),
        ("tie", "2026-01-01", 1.0, 1), ("tie", "2026-01-01", 2.0, 2),
        (None, "2026-01-01", 9.0, 1),
    ])
    snap = latest_snapshot(rows)
    assert "seq" not in snap.columns
    assert values(snap, "symbol", "close", "prev_close", "change", "change_pct") == [
        ("hole", 6.0, None, None, None), ("one", 5.0, None, None, None),
        ("tie", 2.0, 1.0, 1.0, 100.0), ("zero", 5.0, 0.0, 5.0, None)]


def test_snapshot_of_a_renamed_symbol(observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("A", "2026-01-02", 2.0, 2)])
    rows = rows.withColumn("indicator_name", F.when(F.col("seq") == 1, "z").otherwise("a"))
    assert latest_snapshot(rows).first()["close"] == 2.0
    assert latest_snapshot(rows, name_first=True).first()["close"] == 1.0


def test_snapshot_ships_two_rows_per_symbol_and_task(observations):
    plan = plan_of(latest_snapshot(observations([("A", "2026-01-01", 1.0, 1)])))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("row_number(), 2, Partial") == 1


def test_table_order(observations):
    rows = observations([(s, "2026-01-01", 1.0, 1) for s in "cab"])
    rows = rows.withColumn("region", F.when(F.col("symbol") == "a", None).otherwise("r"))
    assert [r["symbol"] for r in in_table_order(rows).collect()] == ["b", "c", "a"]
