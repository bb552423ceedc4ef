import datetime as dt
import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from almanac.operators.history import active_symbols
from almanac.sinks.csv import write_csv
from almanac.sources import catalog as C
from almanac.sources.ohlcv import ohlcv_values
from almanac.sources.series import read_series_files, series_values
from almanac.sources.tables import read_observations, read_text_table

DAY = dt.date
AT = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)


def test_catalog_allows_missing_keys(spark, tmp_path):
    entries = [
        {"symbol": "A", "name": "a", "refresh": "daily", "source_type": C.SERIES,
         "series_id": "A"},
        {"symbol": "B", "name": "b", "source_type": C.DERIVED, "formula": "multiply",
         "series_ids": ["A", "A"], "refresh": "monthly"},
        {"symbol": "", "name": "c", "series_position": 3, "url": "u"},
        {"symbol": "A", "name": "d"},
    ]
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(entries, indent=1), encoding="utf-8")
    catalog = C.read_catalog(spark, str(path))
    assert values(catalog, "pos", "symbol", "series_position") == [
        (0, "A", None), (1, "B", None), (2, "", 3), (3, "A", None)]
    assert catalog.where("pos = 1").first()["series_ids"] == ["A", "A"]
    assert values(C.by_refresh(catalog, "monthly"), "symbol") == [("B",)]
    assert C.by_refresh(catalog, None).count() == 4
    assert values(C.of_type(catalog, C.OHLCV), "pos") == [(2,), (3,)]
    assert values(active_symbols(catalog), "symbol") == [("A",), ("B",)]


def test_csv_round_trip_and_missing_path(spark, tmp_path):
    df = spark.createDataFrame(
        [(DAY(2026, 1, 2), "x", 1.5, None, AT), (DAY(2026, 1, 3), None, None, "", AT)],
        "date date, symbol string, close double, unit string, fetched_at timestamp")
    path = str(tmp_path / "h")
    write_csv(df.coalesce(1), path)
    part = next((tmp_path / "h").glob("part-*.csv")).read_bytes()
    assert part == (
        b"\xef\xbb\xbfdate,symbol,close,unit,fetched_at\n"
        b"2026-01-02,x,1.5,,2026-05-01T00:00:00.000000+00:00\n"
        b"2026-01-03,,,,2026-05-01T00:00:00.000000+00:00\n")
    back = read_observations(spark, path)
    assert values(back, "date", "symbol", "close", "open", "unit") == [
        (DAY(2026, 1, 2), "x", 1.5, None, None), (DAY(2026, 1, 3), None, None, None, None)]
    assert back.select(F.max(F.col("fetched_at") == F.lit(AT))).first()[0]
    assert read_text_table(spark, str(tmp_path / "absent")) is None
    empty = read_observations(spark, str(tmp_path / "absent"))
    assert empty.count() == 0 and empty.columns == back.columns


def test_csv_text_survives(spark, tmp_path):
    odd = [' lead', 'trail ', 'a,b', 'say "hi"', "back\\slash", '"', "　wide　", "NA", "tab\tx"]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(odd)], "symbol string, unit string")
    for sep in (",", "\t"):
        path = str(tmp_path / ("c" if sep == "," else "t"))
        write_csv(df.coalesce(1), path, sep=sep)
        back = read_text_table(spark, path, sep)
        assert values(back, "symbol", "unit") == values(df, "symbol", "unit")
    text = next((tmp_path / "c").glob("part-*.csv")).read_text("utf-8-sig")
    assert '3,"say ""hi"""\n' in text and "1,trail \n" in text
    lines = spark.createDataFrame([("a", "x\ny")], "symbol string, unit string")
    write_csv(lines, str(tmp_path / "m"))
    assert read_text_table(spark, str(tmp_path / "m"), multi_line=True).first()["unit"] == "x\ny"


def test_csv_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("date,symbol,close\n" + "".join(
        f"2026-01-02,A,{i}\n" for i in range(5000)), encoding="utf-8")
    rows = read_observations(spark, str(path))
    last = rows.orderBy(F.desc("seq")).first()
    assert last["close"] == 4999.0


def test_series_values(spark):
    bodies = [
        ("X", "﻿observation_date,X\r\n2026-01-02,1.5\r\n2026-01-03,.\r\n\r\n2026-01-05,2\r\n"),
        ("Y", "Y, Date ,other\n7,2026-01-02,1\n8,bad,1\n"),
        ("Z", "when,value,z\n2026/01/02,3,4\n"),
        ("Q", '"d","Q"\n"2026-01-02","1,5"\n"2026-01-03","6"\n'),
        ("ONE", "DATE\n2026-01-02\n"),
        ("EMPTY", "DATE,EMPTY\n"),
        ("SHORT", "DATE,SHORT\n2026-01-02\n"),
        ("NONE", ""),
    ]
    df = spark.createDataFrame([(s, b, AT) for s, b in bodies],
                               "series_id string, body string, fetched_at timestamp")
    assert values(series_values(df), "series_id", "date", "close") == [
        ("Q", DAY(2026, 1, 3), 6.0), ("X", DAY(2026, 1, 2), 1.5), ("X", DAY(2026, 1, 5), 2.0),
        ("Y", None, 8.0), ("Y", DAY(2026, 1, 2), 7.0), ("Z", DAY(2026, 1, 2), 3.0)]


def test_lines_of_any_white_space_are_no_rows(spark):
    body = "DATE,S\n\u3000\u2028\n2026-01-01,1\n\x1c \x1f\n\u20282026-01-02,2\u2029\n\t\n"
    df = spark.createDataFrame([("S", body, AT)], "series_id string, body string, fetched_at timestamp")
    rows = series_values(df)
    assert values(rows, "date", "close", "row") == [(DAY(2026, 1, 1), 1.0, 0)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(split" in plan and "rlike" in plan.lower()


def test_series_files(spark, tmp_path):
    (tmp_path / "S1.csv").write_text("DATE,S1\n2026-01-02,1\n")
    (tmp_path / "S2.csv").write_text(" S2 ,x, date \n5,9,2026-01-03\n")
    landed = read_series_files(spark, str(tmp_path))
    assert values(series_values(landed), "series_id", "date", "close") == [
        ("S1", DAY(2026, 1, 2), 1.0), ("S2", DAY(2026, 1, 3), 5.0)]


def test_files_count_in_the_order_of_their_paths(spark, tmp_path):
    """Spark packs files by size, so that the largest one would come first."""
    for number, rows in ((0, 1), (1, 400), (2, 3)):
        lines = [f"2026-01-02,f{number},{i}" for i in range(rows)]
        (tmp_path / f"part-{number}.csv").write_text("date,symbol,close\n" + "\n".join(lines) + "\n")
    rows = read_observations(spark, str(tmp_path)).orderBy("seq").select("symbol", "close").collect()
    assert [tuple(r) for r in rows] == [
        (f"f{n}", float(i)) for n, k in ((0, 1), (1, 400), (2, 3)) for i in range(k)]


def test_catalogs_count_in_the_order_of_their_paths(spark, tmp_path):
    for number, entries in (("b", 1), ("a", 50), ("c", 2)):
        (tmp_path / f"{number}.json").write_text(
            json.dumps([{"symbol": f"{number}{i}"} for i in range(entries)]))
    rows = C.read_catalog(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r["symbol"] for r in rows] == [
        f"{n}{i}" for n, k in (("a", 50), ("b", 1), ("c", 2)) for i in range(k)]
    assert len({r["pos"] for r in rows}) == 53


def test_ohlcv_values(spark):
    raw = spark.createDataFrame(
        [("A", dt.datetime(2025, 4, 30), 1.0, 9.0), ("A", dt.datetime(2025, 5, 1), 2.0, 9.0),
         ("A", dt.datetime(2025, 5, 1, 12), 3.0, 9.0)],
        "symbol string, Date timestamp, Close double, Volume double")
    rows = ohlcv_values(raw, DAY(2026, 5, 1))
    assert values(rows, F.col("date").cast("date"), "close", "open", "adj_close", "volume") == [
        (DAY(2025, 5, 1), 2.0, None, None, 9.0), (DAY(2025, 5, 1), 3.0, None, None, 9.0)]
    assert rows.orderBy(F.desc("row")).first()["close"] == 3.0
    assert ohlcv_values(raw).count() == 3


@pytest.mark.parametrize("sep", [",", "\t"])
def test_empty_frames_still_get_a_header(spark, tmp_path, sep):
    df = spark.createDataFrame([], "a string, b double")
    write_csv(df, str(tmp_path / "e"), sep=sep, bom=False)
    parts = list((tmp_path / "e").glob("part-*.csv"))
    assert [p.read_text() for p in parts] == [f"a{sep}b\n"]
