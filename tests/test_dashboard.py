import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from almanac.plans import dashboard as D
from almanac.schemas import LATEST_TABLE_COLUMNS

DAY = dt.date


@pytest.fixture
def history(observations):
    rows = []
    for i, symbol in enumerate("ABCDEF"):
        rows += [(symbol, "2026-01-01", 100.0, 1), (symbol, "2026-06-30", 100.0 + i, 2)]
    rows += [("G", "2026-03-01", 5.0, 1), ("H", "2025-01-01", 1.0, 1)]
    df = observations(rows)
    return df.withColumns({
        "category": F.when(F.col("symbol").isin("A", "B"), "PMI").when(
            F.col("symbol") == "H", None).otherwise("FX"),
        "region": F.when(F.col("symbol") == "C", "Japan").otherwise("Global"),
        "unit": F.lit("u"), "source": F.lit("s"),
    })


def test_dataset_coerces_what_is_there(spark):
    raw = spark.createDataFrame(
        [("2026-01-01", "1.5", "x"), ("2026/01/02", "2", "3"), ("bad", "2", "3"), ("2026-01-03", "ND", "3")],
        "date string, close string, change string")
    assert values(D.dataset(raw), "date", "close", "change") == [
        (DAY(2026, 1, 1), 1.5, None), (DAY(2026, 1, 2), 2.0, 3.0)]


def test_facets_and_extent(history):
    got = [tuple(r) for r in D.facet_values(history).collect()]
    assert got == [("category", "FX"), ("category", "PMI"), ("refresh", "daily"),
                   ("region", "Global"), ("region", "Japan")]
    assert tuple(D.date_extent(history).first()) == (
        DAY(2025, 1, 1), DAY(2026, 6, 30), DAY(2026, 1, 1))
    short = history.where("date >= '2026-03-01'")
    assert D.date_extent(short).first()["default_start"] == DAY(2026, 3, 1)


def test_trend_is_closed_at_both_ends(history):
    chosen = D.Selection(category=["PMI"])
    rows = D.trend(history, chosen, "2026-01-01", DAY(2026, 6, 30))
    assert rows.columns == ["indicator_name", "symbol", "date", "close"]
    assert [(r["symbol"], r["date"].month) for r in rows.collect()] == [
        ("A", 1), ("A", 6), ("B", 1), ("B", 6)]
    assert D.trend(history, chosen, "2026-01-02", "2026-06-29").count() == 0


def test_selection(history):
    def kept(**chosen):
        return {r["symbol"] for r in history.where(D.Selection(**chosen).condition()).collect()}

    assert kept() == set("ABCDEFG")
    assert kept(category=[]) == set()
    assert kept(category=["FX", "PMI"], region=["Japan"]) == {"C"}
    assert kept(refresh=["monthly"]) == set()


def test_latest_table_is_not_narrowed_by_dates(history):
    rows = D.latest_table(history, D.Selection(region=["Global"]))
    assert rows.columns == LATEST_TABLE_COLUMNS
    assert [r["indicator_name"] for r in rows.collect()] == ["D", "E", "F", "G", "A", "B"]
    assert rows.where("indicator_name = 'F'").first()["change_pct"] == 5.0


def test_headline(history):
    cards = D.headline(D.latest_rows(history, D.Selection())).collect()
    assert [(r["symbol"], r["close_text"], r["delta_text"]) for r in cards] == [
        ("F", "105.00", "+5.00%"), ("E", "104.00", "+4.00%"), ("D", "103.00", "+3.00%"),
        ("C", "102.00", "+2.00%")]
    rest = D.headline(D.latest_rows(history, D.Selection()).where("symbol in ('G', 'A')"))
    assert [(r["symbol"], r["delta_text"]) for r in rest.collect()] == [("A", "+0.00%"), ("G", "-")]
    plan = D.headline(D.latest_rows(history, D.Selection()))._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_category_filter_stays_above_the_snapshot(observations):
    rows = observations([("A", "2026-01-01", 1.0, 1), ("A", "2026-01-02", 2.0, 2)])
    rows = rows.withColumn("category", F.when(F.col("seq") == 1, "FX").otherwise("PMI"))
    assert D.latest_rows(rows, D.Selection(category=["FX"])).count() == 0
