import datetime as dt
import io
import os
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from almanac.operators import wide as W
from almanac.plans.wide_index import index_from_archives, index_from_table, ingest_archives
from almanac.schemas import INDEX_COLUMNS
from almanac.sinks.csv import write_yearly
from almanac.sources.archives import archive_records, archive_rejects, read_archives

DAY = dt.date
FIRST, SECOND = list(W.TARGET_SERIES)


def table(months=("202001", "202002"), rows=None):
    rows = rows or [
        ("c1", FIRST, "国内/総平均", "1.5", ""),
        ("c2", FIRST, "工業製品/__食料品 /x", "2", "ND"),
        ("c3", SECOND, "電力", "3.25", "4"),
        ("c4", "unknown", "電力", "9", "9"),
        ("c5", SECOND, "　電力　", "3.25", "5"),
        ("c6", SECOND, "", "1", ""),
    ]
    lines = [",".join(["コード", "系列名", "ラベル", *months, "備考"])]
    lines += [",".join([*r, "x"]) for r in rows]
    return "\r\n".join(lines) + "\r\n"


def archive(path, content, encoding="cp932", member="data/INDEX.CSV"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("readme.txt", "not this one")
        if member:
            z.writestr(member, content.encode(encoding) if isinstance(content, str) else content)
            z.writestr("second.csv", "nor, this, one")
    path.write_bytes(buffer.getvalue())


WANT = sorted([
    (DAY(2020, 1, 1), "輸入物価指数/円ベース", "総平均", "", 1.5, "c1"),
    (DAY(2020, 1, 1), "輸入物価指数/円ベース", "工業製品", "食料品 /x", 2.0, "c2"),
    (DAY(2020, 1, 1), "消費税を除く国内企業物価指数", "電力", "", 3.25, "c3"),
    (DAY(2020, 2, 1), "消費税を除く国内企業物価指数", "電力", "", 4.0, "c3"),
    (DAY(2020, 2, 1), "消費税を除く国内企業物価指数", "電力", "", 5.0, "c5"),
    (DAY(2020, 1, 1), "消費税を除く国内企業物価指数", None, "", 1.0, "c6"),
], key=repr)
SHOWN = ["date", "indicator_name", "classification1", "classification2", "close", "code"]


@pytest.mark.parametrize("encoding,won", [
    ("cp932", "cp932"), ("shift_jis", "cp932"), ("utf-8", "utf-8-sig"), ("utf-8-sig", "utf-8-sig")])
def test_archive_to_tidy_rows(spark, tmp_path, encoding, won):
    archive(tmp_path / "a.zip", table(), encoding)
    rows = read_archives(spark, str(tmp_path))
    tidy = index_from_archives(rows)
    assert tidy.columns == INDEX_COLUMNS
    assert values(tidy, *SHOWN) == WANT
    assert values(tidy.select("category", "region", "refresh", "source", "unit").distinct(),
                  "category", "region", "refresh", "source", "unit") == [
        ("Inflation", "Japan", "monthly", "Bank of Japan", "Index 2020=100")]
    assert rows.select("encoding").distinct().first()[0] == won


def test_explicit_encoding(spark, tmp_path):
    archive(tmp_path / "a.zip", table(), "utf-8")
    rows = read_archives(spark, str(tmp_path), encodings=("utf-8",))
    assert values(index_from_archives(rows), *SHOWN) == WANT


def test_first_file_row_stays_across_archives(spark, tmp_path):
    late = [("late", SECOND, "電力", "3.25", "4"), ("own", SECOND, "ガス", "1", "2")]
    archive(tmp_path / "b.zip", table(("202001", "202003"), late), "utf-8")
    archive(tmp_path / "a.zip", table())
    tidy = index_from_archives(read_archives(spark, str(tmp_path)))
    assert values(tidy.where("classification1 = '電力'"), "date", "close", "code") == [
        (DAY(2020, 1, 1), 3.25, "c3"), (DAY(2020, 2, 1), 4.0, "c3"), (DAY(2020, 2, 1), 5.0, "c5"),
        (DAY(2020, 3, 1), 4.0, "late")]
    assert tidy.where("code = 'own'").count() == 2


def test_rejected_archives(spark, tmp_path):
    archive(tmp_path / "none.zip", "", member=None)
    archive(tmp_path / "bytes.zip", b"a,b\xff\xff\n\x81")
    archive(tmp_path / "ragged.zip", "a,b,c,202001\n1,2,3,4,5\n", "utf-8")
    archive(tmp_path / "months.zip", "a,b,c,2020\n1,2,3,4\n", "utf-8")
    (tmp_path / "broken.zip").write_bytes(b"PK no")
    archive(tmp_path / "good.zip", table())
    rows = read_archives(spark, str(tmp_path))
    got = [(p.rsplit("/", 1)[1], r) for p, r in values(archive_rejects(rows), "path", "reason")]
    assert sorted(got) == [
        ("broken.zip", "not a zip archive"), ("bytes.zip", "no encoding reads the member"),
        ("months.zip", "no month columns"), ("none.zip", "no CSV member"),
        ("ragged.zip", "no encoding reads the member")]
    assert values(index_from_archives(rows), *SHOWN) == WANT


def test_many_rows_keep_their_order(spark, tmp_path):
    rows = [(f"c{i}", SECOND, "電力", "7", "") for i in range(7000)]
    archive(tmp_path / "a.zip", table(rows=rows))
    records = read_archives(spark, str(tmp_path))
    assert archive_records(records).count() == 7000
    assert values(index_from_archives(records), "code") == [("c0",)]


def test_short_records_and_repeated_months(spark, tmp_path):
    content = "a,b,c,202001,202001,202002\n" + f"k,{FIRST},x,1,2\n" + "\n" + f"m,{FIRST},y\n"
    archive(tmp_path / "a.zip", content, "utf-8")
    tidy = index_from_archives(read_archives(spark, str(tmp_path)))
    assert values(tidy, "code", "date", "close") == [("k", DAY(2020, 1, 1), 1.0)]


def wide_frame(spark, months=("202001", "202002")):
    return spark.createDataFrame(
        [("c1", FIRST, "a/b", "1", None, "n", 1), ("c2", FIRST, "a/b", "1", "x", "n", 2),
         ("c3", "other", "a", "1", "1", "n", 3)],
        ["id", "name", "label", *months, "note", "file_row"])


def test_wide_frame(spark):
    long = W.melt_columns(W.name_ids(wide_frame(spark), ("file_row",)))
    assert long.columns == ["code", "series_name", "label_raw", "yyyymm", "close"]
    assert long.count() == 6 and long.where("close is null").count() == 1
    tidy = index_from_table(wide_frame(spark), ["file_row"])
    assert values(tidy, "code", "date", "classification1", "classification2", "close") == [
        ("c1", DAY(2020, 1, 1), "a", "b", 1.0)]


def test_month_columns_are_required_and_checked(spark):
    with pytest.raises(ValueError, match="month columns"):
        W.month_columns(spark.createDataFrame([(1,)], ["2020"]))
    bad = wide_frame(spark, ("202001", "202013"))
    bad = bad.withColumn("202013", F.lit("5"))
    with pytest.raises(Exception, match="20201301|PARSE"):
        index_from_table(bad, ["file_row"]).collect()
    lenient = index_from_table(bad, ["file_row"], strict_months=False)
    assert values(lenient, "date") == [(DAY(2020, 1, 1),)]
    # A bad month without numbers is no error, as its cells are dropped first.
    assert index_from_table(bad.withColumn("202013", F.lit("ND")), ["file_row"]).count() == 1


def test_unpivot_then_pivot_is_the_identity(spark):
    rows = [(f"c{i}", FIRST, f"l{i}", str(i), str(i * 2)) for i in range(20)]
    wide = spark.createDataFrame(rows, [*W.IDS, "202001", "202002"])
    back = W.melt_columns(wide).groupBy(*W.IDS).pivot("yyyymm", ["202001", "202002"]).agg(
        F.first("close"))
    assert values(back, *wide.columns) == values(wide, *wide.columns)


def test_index_order(spark):
    tidy = spark.createDataFrame(
        [("b", DAY(2020, 1, 1), "x", "", 1.0), ("a", DAY(2020, 2, 1), "x", "", 1.0),
         ("a", DAY(2020, 1, 1), None, "", 1.0), ("a", DAY(2020, 1, 1), "z", "", 1.0)],
        "indicator_name string, date date, classification1 string, classification2 string, "
        "close double")
    got = [(r[0], r[1].month, r[2]) for r in W.in_index_order(tidy).collect()]
    assert got == [("a", 1, "z"), ("a", 1, None), ("a", 2, "x"), ("b", 1, "x")]


def test_ingest_writes_every_export(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("c1", FIRST, "b", "1", "2"), ("c2", FIRST, "a", "3", "4")]
    archive(tmp_path / "in" / "a.zip", table(("201912", "202001"), rows))
    out = tmp_path / "out"
    run = ingest_archives(spark, str(tmp_path / "in"), str(out))
    assert run.rows == 4 and run.rejects.count() == 0
    assert [r["close"] for r in run.table.collect()] == [3.0, 1.0, 4.0, 2.0]

    def lines(folder, suffix="csv"):
        parts = sorted((out / folder).rglob(f"part-*.{suffix}"))
        return [line for p in parts for line in p.read_text("utf-8-sig").splitlines()
                if not line.startswith("date")]

    assert [x.split(",")[4] for x in lines("index_csv")] == ["3.0", "1.0", "4.0", "2.0"]
    assert lines("index_tsv")[0].split("\t") == [
        "2019-12-01", "輸入物価指数/円ベース", "a", "", "3.0"]
    assert sorted(p.name for p in (out / "yearly").glob("year=*")) == ["year=2019", "year=2020"]
    assert [x.split(",")[-3] for x in lines("yearly/year=2020")] == ["c2", "c1"]
    assert lines("yearly_lite/year=2020")[0] == "2020-01-01,輸入物価指数/円ベース,a,,4.0"


def test_yearly_files_of_some_years(spark, tmp_path):
    rows = [("c1", FIRST, "b", "1", "2")]
    archive(tmp_path / "a.zip", table(("202612", "203001"), rows))
    tidy = index_from_archives(read_archives(spark, str(tmp_path)))
    write_yearly(tidy, str(tmp_path / "all"), str(tmp_path / "all_lite"))
    write_yearly(tidy, str(tmp_path / "some"), str(tmp_path / "some_lite"), range(2020, 2027))
    years = {n: sorted(p.name for p in (tmp_path / n).glob("year=*")) for n in ("all", "some")}
    assert years == {"all": ["year=2026", "year=2030"], "some": ["year=2026"]}


def test_an_archive_with_a_header_only(spark, tmp_path):
    archive(tmp_path / "months.zip", "a,b,c,202001\n", "utf-8")
    archive(tmp_path / "none.zip", "a,b,c,d\n", "utf-8")
    rows = read_archives(spark, str(tmp_path))
    assert [(p.rsplit("/", 1)[1], r) for p, r in values(archive_rejects(rows), "path", "reason")] == [
        ("none.zip", "no month columns")]
    assert index_from_archives(rows).count() == 0


def test_python_runs_on_executors_from_any_folder(tmp_path):
    """The package is shipped: the workers don't start in the folder that has it."""
    code = (
        "import sys; sys.path.append(sys.argv[1])\n"
        "import __spark_entry__ as entry\n"
        "from almanac.session import local_session\n"
        "spark = local_session('away', cores=2, shuffle_partitions=2)\n"
        "sys.path.remove(sys.argv[1])\n"
        "print('rows', entry.queries()['archive_ingest'](spark, entry.SMOKE_DIR).count())\n")
    root = str(Path(__file__).resolve().parents[1])
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, capture_output=True,
                          text=True, timeout=300, env=environment)
    assert "rows " in done.stdout, done.stderr[-2000:]
