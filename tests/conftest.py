import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from almanac.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def observations(spark):
    """Frame of ``(symbol, date, close, seq)`` with a name and the facets filled in."""

    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(
            [(s, dt.date.fromisoformat(d) if d else None, c, q) for s, d, c, q in rows],
            "symbol string, date date, close double, seq bigint")
        return df.withColumns({
            "indicator_name": F.col("symbol"), "category": F.lit("FX"),
            "region": F.lit("Global"), "refresh": F.lit("daily"),
        })

    return make


def values(df, *columns):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
