"""Properties on generated histories, against plain Python models."""

import datetime as dt

from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from almanac.operators.history import latest_arrivals, replace_rows, upsert
from almanac.operators.snapshot import latest_snapshot, yearly_tails

DAYS = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 1, 1),
        dt.date(2021, 1, 2), None]
ROWS = st.lists(st.tuples(
    st.sampled_from(["A", "B", "C", None]), st.sampled_from(DAYS),
    st.one_of(st.none(), st.integers(-50, 50).map(float))), min_size=1, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(observations, rows):
    return observations([(s, d and d.isoformat(), c, i) for i, (s, d, c) in enumerate(rows)])


def model(*loads):
    kept = {}
    for rows in loads:
        for symbol, day, close in rows:
            if day is not None and day >= dt.date(2020, 1, 1):
                kept[symbol, day] = close
    return kept


@SETTINGS
@given(old=ROWS, new=ROWS)
def test_upsert_is_last_write_wins_and_idempotent(observations, old, new):
    want = sorted(((s, d, c) for (s, d), c in model(old, new).items()), key=repr)
    merged = upsert(frame(observations, old), frame(observations, new))
    assert values(merged, "symbol", "date", "close") == want
    batch = upsert(frame(observations, new), frame(observations, new).limit(0))
    for again in (upsert(merged, frame(observations, new)), replace_rows(merged, batch)):
        assert values(again, "symbol", "date", "close") == want


@SETTINGS
@given(rows=ROWS)
def test_snapshot_has_one_row_per_symbol(observations, rows):
    rows = [r for r in rows if r[1] is not None]
    series = {}
    for (symbol, day), close in sorted(model(rows).items(), key=lambda x: x[0][1]):
        if symbol is not None:
            series.setdefault(symbol, []).append((day, close))
    want = sorted(((s, *v[-1], v[-2][1] if len(v) > 1 else None) for s, v in series.items()),
                  key=repr)
    history = latest_arrivals(frame(observations, rows).where("date >= '2020-01-01'"))
    snapshot = latest_snapshot(history)
    assert values(snapshot, "symbol", "date", "close", "prev_close") == want
    tails = yearly_tails(history.selectExpr("*", "year(date) AS year"))
    assert values(latest_snapshot(tails), "symbol", "date", "close", "prev_close") == want
