import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR
from check import TABLES, canonical

from almanac.llm.mixing import Mix, mix_documents, mixed_rows, source_targets
from almanac.llm.oracles import ORACLES
from almanac.llm.queries import QUERIES
from almanac.llm.url_reputation import judge_pages


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    yield con
    con.close()


def same(df, con, name):
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want, columns)
    return want


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sql, name):
    for table in TABLES:
        sql.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
    assert same(QUERIES[name](spark, SMOKE_DIR), sql, name)


def shown_to(sql, **frames):
    for name, df in frames.items():
        sql.execute(f"DROP VIEW IF EXISTS {name}")
        sql.register(name, df.toArrow())


def test_mix_of_messy_documents_equals_sql(messy, sql):
    shown_to(sql, documents=messy)
    want = same(mix_documents(messy), sql, "op9_source_mix")
    assert all(taken <= 2 * size for _, size, _, _, taken in want)


def test_targets_are_met_and_capped(spark):
    sizes = [("a", 1000), ("b", 10), ("c", 500), (None, 90), ("d", 0)]
    targets = {r["source"]: r["target"] for r in source_targets(
        spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    assert sum(targets.values()) == pytest.approx(1.5 * 1600)
    assert all(targets[s] <= 2 * n for s, n in sizes) and targets["d"] == 0
    free = {s: targets[s] / w for (s, n), w in zip(
        sorted(sizes, key=lambda r: (r[0] is None, r[0])), (3, 1, 2, 3, 1)) if targets[s] < 2 * n}
    assert max(free.values()) == pytest.approx(min(free.values()))


def test_taken_words_meet_the_target(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('w ', int(1 + id % 90)) as text",
        "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "1 as place", "'x' as bucket")
    rows = mix_documents(docs).toPandas()
    assert sorted(rows.doc_id) == list(range(3000))
    rows["source"] = [("hot" if i % 3 == 0 else f"s{i % 7}") for i in rows.doc_id]
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (by.taken - by.target).abs().max() <= 1
    again = mix_documents(docs.repartition(5)).toPandas().sort_values("doc_id")
    assert (again.taken.values == rows.sort_values("doc_id").taken.values).all()
    other = mix_documents(docs, Mix(seed="other")).toPandas().sort_values("doc_id")
    assert (other.taken.values != again.taken.values).any()


def test_mixed_rows_repeat_and_cut(messy):
    taken = sum(r["taken"] for r in mix_documents(messy).collect())
    rows = mixed_rows(messy)
    assert rows.columns == messy.columns
    assert sum(len((r["text"] or "").split()) for r in rows.collect()) == pytest.approx(taken, abs=3)


def test_no_documents(no_documents):
    assert mix_documents(no_documents).count() == 0 and mixed_rows(no_documents).count() == 0


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/")]
PAGES = [
    (1, "https://a.Example.NET/en/1?x#y"), (2, "http://example.net/enx"), (3, "http://b.net"),
    (4, "http://notexample.net/en/"), (5, "x://EXAMPLE.com/de/"), (6, "http://a.org/fr/b://c"),
    (7, None), (8, "no scheme"), (9, ""), (10, "http://"), (11, "http:///path"), (None, "http://h.io/"),
    (12, "http://h.io/p"), (12, "http://h.io/p"), (13, "http://bad.io/p"), (14, "http://bad.io/q"),
    (15, "http://ÄÖ.example.com/de"), (16, "http://net/"), (17, "http://a.net?q=/en/"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, u, "h", 0.1, "r") for i, u in PAGES],
                                 "page_id long, url string, host string, n double, rule string")


def test_messy_pages_equal_sql(spark, pages, sql):
    labels = spark.createDataFrame(
        [(12, 1), (13, 0), (14, 0), (14, 0), (1, None), (None, 1), (99, 0)], "doc_id long, quality int")
    shown_to(sql, pages=pages.select("page_id", "url"), labels=labels)
    judged = judge_pages(pages, labels.toDF("page_id", "good"), RULES)
    rows = {r["page_id"]: r for r in judged.collect()}
    assert [rows[i]["rule"] for i in (1, 2, 3, 4, 5, 6)] == [
        "example.net/en/", "net/", None, "net/", "example.com/de/", "org/fr/"]
    assert rows[7]["host"] == rows[8]["path"] == "" and rows[11]["path"] == "/path"
    assert rows[13]["verdict"] == "block" and rows[16]["verdict"] == "block"
    same(judged, sql, "op5_url_reputation")


def test_hosts_shrink_towards_their_domain(spark):
    hosts = [("good.site.com", 40, 1), ("alsogood.site.com", 30, 1), ("bad.spam.com", 40, 0),
             ("new.site.com", 0, 0), ("new.spam.com", 0, 0), ("one.spam.com", 1, 1)]
    pages = [(f"{h}{i}", f"http://{h}/") for h, n, _ in hosts for i in range(max(1, n))]
    labels = [(f"{h}{i}", good) for h, n, good in hosts for i in range(n)]
    judged = judge_pages(spark.createDataFrame(pages, "page_id string, url string"),
                         spark.createDataFrame(labels, "page_id string, good int"), [])
    bound = {r["host"]: r["posterior_bound"] for r in judged.collect()}
    assert bound["good.site.com"] > bound["new.site.com"] > bound["new.spam.com"]
    verdict = {r["host"]: r["verdict"] for r in judged.collect()}
    assert verdict == {h: "allow" if "site" in h else "block" for h, _, _ in hosts}


def test_no_pages_or_labels(spark, pages):
    labels = spark.createDataFrame([], "page_id long, good int")
    assert judge_pages(pages.limit(0), labels, RULES).count() == 0
    assert judge_pages(pages, labels, []).count() == len(PAGES)
