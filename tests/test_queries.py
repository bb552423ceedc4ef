import duckdb
import pytest
from check import TABLES, canonical

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from almanac.workload import queries as workload
from almanac.workload.oracles import ORACLES
from almanac.workload.queries import QUERIES
from almanac.workload.scratch import scratch_dir


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMOKE_DIR}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    result = tables.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert expected, "the SQL has rows to compare"
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expected, columns)


def test_catalog_files_hold_a_bounded_number_of_entries(spark, tables, monkeypatch):
    written = []
    monkeypatch.setattr(workload, "scratch_dir",
                        lambda *args: written.append(scratch_dir(*args)) or written[-1])
    monkeypatch.setattr(workload, "ENTRIES_PER_FILE", 2, raising=False)
    df = QUERIES["catalog_file"](spark, SMOKE_DIR)
    result = tables.execute(ORACLES["catalog_file"])
    columns = [d[0] for d in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(
        result.fetchall(), columns)
    sizes = [r["value"].count('"symbol"') for r in spark.read.text(written[0], wholetext=True).collect()]
    assert len(sizes) > 25 and max(sizes) <= 2


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 4 and rows[0]["change_pct"] >= rows[-1]["change_pct"]


def test_scratch_folder_is_shared_on_a_cluster():
    class Session:
        def __init__(self, master, shared=None):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: shared)})

    assert scratch_dir(Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert scratch_dir(Session("local[2]"), "x") != scratch_dir(Session("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")
