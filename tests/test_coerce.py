import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from almanac.functions import coerce as C
from almanac.functions.display import delta_text, number_text
from almanac.functions.labels import classification


def column(spark, raw, make, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_numbers(spark):
    cases = {
        "1.5": 1.5, " 2 ": 2.0, "1e3": 1000.0, "inf": math.inf, "-Infinity": -math.inf,
        "+.5": 0.5, "5.": 5.0, " inf": None, "infinit": None, "1e": None, "-1E-2\n": -0.01, "\t3": 3.0, ".": None, "": None, "ND": None, "1,234": None,
        "1.5d": None, "0x10": None, "True": None, "nan": None, "1 2": None,
    }
    assert column(spark, list(cases), C.to_number) == list(cases.values())


def test_number_columns_by_type(spark):
    df = spark.createDataFrame([(1, math.nan, "7")], "volume bigint, close double, open string")
    row = C.coerce_numbers(df, ["open", "high", "close", "volume"]).first()
    assert row.asDict() == {"volume": 1.0, "close": None, "open": 7.0}


def test_days(spark):
    cases = {
        "2026-02-01": dt.date(2026, 2, 1), "2026/02/01": dt.date(2026, 2, 1),
        "2026-2-1": dt.date(2026, 2, 1), " 2026-02-01 ": dt.date(2026, 2, 1),
        "2026-02-01 05:00:00": dt.date(2026, 2, 1),
        "2026-05-21T02:44:30.154369+00:00": dt.date(2026, 5, 21),
        "2026": None, "abc": None, "": None, "2026-02-30": None, "2026-13-01": None,
        "2026-02/01": None, "2026-02-01x": None,
    }
    assert column(spark, list(cases), C.to_day) == list(cases.values())


def test_day_columns_by_type(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2, 23),)], "date timestamp")
    assert df.select(C.coerce_day(df)).first()[0] == dt.date(2026, 1, 2)


def test_month_start_is_strict_unless_told(spark):
    assert column(spark, ["202402"], C.month_start) == [dt.date(2024, 2, 1)]
    lenient = column(spark, ["202402", "202413"], lambda c: C.month_start(c, strict=False))
    assert lenient == [dt.date(2024, 2, 1), None]
    with pytest.raises(Exception, match="202413|CANNOT_PARSE|PARSE"):
        column(spark, ["202413"], C.month_start)


def test_edges(spark):
    assert column(spark, ["1,234.5", "x"], C.clean_number) == [1234.5, None]
    assert column(spark, ["　 a b\t\n"], C.strip) == ["a b"]
    assert column(spark, ["", "a", None], C.empty_to_null) == [None, "a", None]
    assert column(spark, [None, "a"], C.or_default) == ["", "a"]
    instant = dt.datetime(2026, 5, 21, 2, 44, 30, 154369, tzinfo=dt.timezone.utc)
    assert column(spark, [instant], C.iso_instant, "timestamp") == [
        "2026-05-21T02:44:30.154369+00:00"]
    assert column(spark, [dt.date(2026, 5, 2)], C.iso_day, "date") == ["2026-05-02"]


def test_number_text(spark):
    cases = [
        (0.125, "0.12"), (1.005, "1.00"), (2.675, "2.67"), (-0.001, "-0.00"),
        (999.995, "1000.00"), (1000.125, "1,000.12"), (1234.565, "1,234.57"),
        (-1234567.891, "-1,234,567.89"), (None, "-"), (math.nan, "-"), (math.inf, "inf"),
    ]
    got = column(spark, [c[0] for c in cases], number_text, "double")
    assert got == [c[1] for c in cases]


def test_number_text_agrees_with_python_formatting(spark):
    raw = [s * (i * 0.005 + j) for i in range(200) for j in (0, 37, 999, 123456) for s in (1, -1)]
    want = [f"{v:,.2f}" if abs(v) >= 1000 else f"{v:.2f}" for v in raw]
    assert column(spark, raw, number_text, "double") == want
    assert column(spark, raw, delta_text, "double") == [f"{v:+.2f}%" for v in raw]


def test_delta_text(spark):
    cases = [(2.99, "+2.99%"), (0.0, "+0.00%"), (-0.0, "-0.00%"), (-1.5, "-1.50%"),
             (1234.5, "+1234.50%"), (None, "-"), (math.nan, "-")]
    got = column(spark, [c[0] for c in cases], delta_text, "double")
    assert got == [c[1] for c in cases]


def test_classification(spark):
    cases = {
        "国内/総平均": ("総平均", ""), "工業製品/__食料品 /x": ("工業製品", "食料品 /x"),
        "電力": ("電力", ""), "　電力　": ("電力", ""), None: (None, ""), "a/ _b": ("a", "_b"),
        "a/b/c": ("a", "b/c"), " a / b ": ("a", "b"), "/x": ("", "x"), "": ("", ""),
    }
    got = column(spark, list(cases), lambda c: F.struct(*classification(c)))
    assert [tuple(r) for r in got] == list(cases.values())
