import datetime as dt

from conftest import values
from pyspark.sql import functions as F

from almanac.functions import pagetext as P
from almanac.sources import pages as S

FETCHED = dt.datetime(2026, 6, 30, 23, 30, tzinfo=dt.timezone.utc)
DAY = dt.date


def page_frame(spark, htmls, label="PMI in Japan", position=5):
    rows = [(f"s{i}", i, h, label, position, FETCHED) for i, h in enumerate(htmls)]
    return spark.createDataFrame(
        rows,
        "symbol string, pos bigint, html string, label string, position int, fetched_at timestamp")


def test_page_text_keeps_entities_and_edges(spark):
    html = "<p class='a\nb'>x &amp; y</p>\n\n\t <b>z</b>　\x1c w "
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(P.page_text("html")).first()[0] == " x &amp; y z w "


def test_labelled_value(spark):
    cases = [
        ("PMI in Japan rose to 1,053.0 points", 1053.0),
        ("pmi IN japan, as noted, was at 7 then fell to 8", 7.0),
        ("PMI in Japan was 12.", 12.0),
        ("PMI in Japan traded at .5 and stood at 6.25%", 6.25),
        ("PMI in Japan | Price | Open 53.1 x", 53.1),
        ("PMI in Japan - price - up 2", 2.0),
        ("other PMI in Japan, PMI in Japan | Price | 9", 9.0),
        ("rose to 5 is PMI in Japan", None),
        ("PMI in Korea rose to 5", None),
    ]
    df = page_frame(spark, [c[0] for c in cases])
    got = df.orderBy("pos").select(P.labelled_value(P.page_text("html"), "label")).collect()
    assert [r[0] for r in got] == [c[1] for c in cases]


def test_label_is_taken_literally(spark):
    df = page_frame(spark, ["A+B (x) was 3", "AAB x was 3", "A+B (x) | Price | 4"], "a+b (X)")
    got = df.orderBy("pos").select(P.labelled_value("html", "label")).collect()
    assert [r[0] for r in got] == [3.0, None, 4.0]


def test_month_reference(spark):
    cases = [
        ("points in February 2026", DAY(2026, 2, 1), False),
        ("in SEPTEMBER 2025", DAY(2025, 9, 1), False),
        ("within Mayfair 2024", DAY(2024, 5, 1), False),
        ("in Japan 2026 and in May 2026", None, True),
        ("In May 2026", None, False),
        ("in May 26", None, False),
    ]
    df = page_frame(spark, [c[0] for c in cases])
    found = df.orderBy("pos").select(F.inline(F.array(P.month_reference("html"))))
    got = [tuple(r) for r in found.collect()]
    assert got == [(c[1], c[2]) for c in cases]


def test_labelled_pages_dates_and_rejects(spark):
    df = page_frame(spark, [
        "PMI in Japan rose to <b>1,053.0</b> points in February 2026",
        "PMI in Japan rose to 5",
        "in Cars 2026: PMI in Japan rose to 5",
        "in Cars 2026: nothing here",
    ])
    good, bad = S.page_rows(df, S.labelled_hits())
    assert values(good, "symbol", "date", "close") == [
        ("s0", DAY(2026, 2, 1), 1053.0), ("s1", DAY(2026, 6, 30), 5.0)]
    assert values(bad, "symbol", "reason") == [("s2", S.BAD_MONTH)]


def test_price_pages(spark):
    head = "<td>Date</td>| Price | Open | --- | --- | "
    df = page_frame(spark, [
        head + "May 15, 2026 | 1,234.5 | 3 |",
        head + "september 1, 2026 | 7 | 3 |",
        head + "Sept 15, 2026 | 1,234.5 | 3 |",
        head + "Feb 30, 2026 | 1 | 3 |",
        "Historical Data Daily 05/15/2025 - 05/15/2026 Date | Price | Jun 3, 2026 | 8.5 | 9",
        "Date | Price | --- | no rows",
        head + "May 15, 2026 | n/a | May 14, 2026 | 5 |",
        "Daily 1/2/2025 - 1/2/2026 Jan 2, 2026" + head + "Sept 1, 2026 | 6 | x",
    ])
    assert values(S.page_rows(df, S.price_hits())[0], "symbol", "date", "close") == [
        ("s0", DAY(2026, 5, 15), 1234.5), ("s1", DAY(2026, 9, 1), 7.0),
        ("s4", DAY(2026, 6, 3), 8.5), ("s7", DAY(2026, 1, 2), 6.0)]
    loose = S.page_rows(df.where("pos = 0"), S.price_hits(anchored=False))[0]
    assert values(loose, "date", "close") == [(DAY(2026, 5, 15), 2026.0)]


def test_period_pages_keep_lines_apart(spark):
    lines = "2020/01 1 2 3 4 5.5\n2020/02 1 2 3 4 ND\r\n2020/03 1 2\n2020/13 1 1 1 1 1\n2020/04 1 2 3 4 x"
    cells = "".join(
        f"<tr>\n<td>2021/{m:02d}</td>\n<td>1</td><td>2</td><td>3</td><td>4</td><td>{m}</td>\n</tr>"
        for m in (1, 2))
    df = page_frame(spark, [f"<pre>{lines}</pre>", f"<table>{cells}</table>", "none",
                            "2022/01 1 2 3 4 5<br/>2022/02 9 9 9 9 6"])
    assert values(S.page_rows(df, S.period_hits())[0], "symbol", "date", "close", "row") == [
        ("s0", DAY(2020, 1, 1), 5.5, 0),
        ("s1", DAY(2021, 1, 1), 1.0, 0), ("s1", DAY(2021, 2, 1), 2.0, 1),
        ("s3", DAY(2022, 1, 1), 5.0, 0), ("s3", DAY(2022, 2, 1), 6.0, 1)]


def test_period_position(spark):
    df = page_frame(spark, ["2020/01 7 8"], position=1)
    assert values(S.page_rows(df, S.period_hits())[0], "close") == [(7.0,)]


def test_whole_long_pages_are_searched(spark):
    filler = "<p>" + "word rose to nothing " * 40_000 + "</p>"
    df = page_frame(spark, [filler + "PMI in Japan" + filler + " was 41.5 in May 2026"])
    good, _ = S.page_rows(df, S.labelled_hits())
    assert values(good, "date", "close") == [(DAY(2026, 5, 1), 41.5)]


def test_page_text_is_bound_once_per_page(spark):
    plan = S.page_rows(page_frame(spark, ["x"]), S.labelled_hits())[0].select(F.col("close"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("<[^>]+>") == 1
