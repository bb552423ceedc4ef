"""The refresh run: fetch, upsert, prune, derive, write, publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from almanac.operators.history import (
    KEY, active_symbols, keep_active, lite, name_order, replace_rows, since, upsert, upsert_by_year,
)
from almanac.operators.joins import fits_broadcast
from almanac.operators.snapshot import TABLE_ORDER, latest_snapshot
from almanac.jobs import at_once, shuffles_removed
from almanac.schemas import MIN_DATE
from almanac.sinks.csv import write_csv, write_segments
from almanac.sinks.store import HistoryStore
from almanac.sources.catalog import by_refresh
from almanac.sources.market import Landing, fetch

SNAPSHOT_REFRESH = "daily"


def _years(df: DataFrame) -> list[int]:
    return [r[0] for r in df.select(F.year("date").alias("y")).distinct().collect()]


def _losing(store: HistoryStore, held: dict[int, dict[str, int]], active: DataFrame) -> list[int]:
    """Years that hold a symbol which isn't active any more."""
    if not held:
        return []
    rows = store.read(held, "tails").select("symbol", "year").distinct()
    lost = rows.join(active, "symbol", "left_anti").select("year").distinct()
    return [r["year"] for r in lost.collect()]


def _below(store: HistoryStore, held: dict[int, dict[str, int]], floor: dt.date) -> set[int]:
    """The floor's own year, if the store holds older rows of it."""
    if floor.year not in held or floor == dt.date(floor.year, 1, 1):
        return set()
    rows = store.read({floor.year: held[floor.year]})
    return set() if rows.where(F.col("date") < F.lit(floor)).isEmpty() else {floor.year}


def _repeats(df: DataFrame, key: str) -> bool:
    return not df.groupBy(key).count().where("count > 1").isEmpty()


def refresh_run(store: HistoryStore, catalog: DataFrame, landing: Landing,
                run_at: dt.datetime, refresh: str | None = None, scope: str = "catalog",
                exports: str | None = None, floor: str = MIN_DATE, bom: bool = True,
                small_batch: bool | None = None, full_exports: bool = True) -> Row:
    """One published run; returns its run-log row with the metrics.

    ``refresh`` limits what is fetched. ``scope`` says which symbols stay in the history: those
    of the whole catalog, or with ``"run"`` only the fetched cadence's. Only years that get new
    rows, or lose inactive symbols or rows below the floor, are rewritten; a batch that meets no held
    year is written as it was fetched. Whether the catalog and
    the batch's keys fit a broadcast is measured once and changes how Spark joins, never the rows.

    With ``exports`` the run writes CSV files under its version before it is published: the
    snapshot, the segments of every held year that the folder lacks, and unless ``full_exports``
    is off the whole history and its lite rows. Single values such as the list of years are all
    that reaches the driver.
    """
    if scope not in ("catalog", "run"):
        raise ValueError("scope is 'catalog' or 'run'")
    with shuffles_removed(store.spark):
        return _run(store, catalog, landing, run_at, refresh, scope, exports, floor, bom,
                    small_batch, full_exports)


def _run(store: HistoryStore, catalog: DataFrame, landing: Landing, run_at: dt.datetime,
         refresh: str | None, scope: str, exports: str | None, floor: str, bom: bool,
         small_batch: bool | None, full_exports: bool) -> Row:
    first = dt.date.fromisoformat(str(floor))
    before = store.last_run()
    held = {y: e for y, e in store.years(before).items() if y >= first.year}
    version = 1 if before is None else before["version"] + 1
    wanted = by_refresh(catalog, refresh)
    active = active_symbols(catalog if scope == "catalog" else wanted)
    small = fits_broadcast(catalog)

    staged: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        rows, _ = store.stage(df, name, version)
        if name == "latest" and "series" in staged:
            staged.remove("series")
            store.drop("series", version)
        staged.append(name)
        return rows

    new = fetch(wanted, landing, run_at, floor, small=small, keep=keep)
    (fetched, n_fetched), (_, n_rejected), losing, below = at_once(
        store.spark,
        lambda: store.stage(new.observations, "fetched", version),
        lambda: store.stage(new.rejects, "rejects", version),
        lambda: _losing(store, held, active),
        lambda: _below(store, held, first))
    for name in staged:
        store.drop(name, version)
    gaining, fits = at_once(
        store.spark, lambda: _years(fetched),
        lambda: fits_broadcast(fetched.select(*KEY)) if small_batch is None else small_batch)
    years = {*gaining, *losing, *below}
    touched = {y: e for y, e in held.items() if y in years}
    # Every fetched symbol is one of the catalog's, so it is active unless it is empty; and one
    # that isn't active makes its year a losing one.
    merged, laid_out, spent = since(fetched.where("symbol <> ''"), floor), fits, "fetched"
    if touched or not fits and _repeats(catalog, "pos"):
        kept = store.read(touched)
        kept = keep_active(kept, active, small) if losing else kept
        if fits:
            merged = replace_rows(kept, merged, floor)
        else:
            merged, _ = store.stage(upsert_by_year(kept, merged, floor), "merged", version)
            laid_out = True
            store.drop("fetched", version)
            spent = "merged"
    written = store.write_years(merged, version, floor, clustered=not laid_out, spent=spent)
    held = {y: e for y, e in held.items() if y not in years} | written

    tails = store.read(held, "tails").drop("year")
    latest = latest_snapshot(tails).where(F.col("refresh") == SNAPSHOT_REFRESH)

    def snapshot() -> int:
        rows, n = store.stage(latest, "snapshot", version)
        if exports is not None:
            write_csv(rows, f"{exports}/latest_snapshot/version={version}", TABLE_ORDER, bom=bom)
        return n

    actions = [snapshot]
    exported = {}
    if exports is not None:
        if before is not None and before["exports"] == exports:
            exported = {int(y): v for y, v in before["exported"].items()
                        if int(y) in held and int(y) not in written}
        missing = {y: e for y, e in held.items() if y not in exported}
        exported |= dict.fromkeys(missing, version)
        actions.append(lambda: write_segments(
            store.read(missing), f"{exports}/segments/version={version}", bom=bom, floor=floor))
        if full_exports:
            history = store.read(held).drop("year")
            rows = lite(history, floor)
            actions += [
                lambda: write_csv(history, f"{exports}/history/version={version}",
                                  name_order(history), bom=bom),
                lambda: write_csv(rows, f"{exports}/history_lite/version={version}",
                                  name_order(rows), bom=bom)]
    n_snapshot = at_once(store.spark, *actions)[0]
    return store.publish(
        version, run_at, refresh, held,
        {"fetched": n_fetched, "rejected": n_rejected, "snapshot": n_snapshot}, exports, exported)


def import_history(store: HistoryStore, rows: DataFrame, run_at: dt.datetime,
                   floor: str = MIN_DATE) -> Row:
    """Publish a history that was kept elsewhere as an empty store's first version.

    ``rows`` are observations as ``read_observations`` gives them: cleaned, cut at the floor, and of
    one symbol's day the last row stays. Later runs upsert into them. A store that has a version
    already is refused, since its rows may be newer.
    """
    if store.last_run() is not None:
        raise ValueError("the store has a history already")
    with shuffles_removed(store.spark):
        cleaned, n = store.stage(upsert(store.read({}).drop("year"), rows, floor), "imported", 1)
        held = store.write_years(cleaned, 1, floor, spent="imported")
    return store.publish(1, run_at, None, held, {"imported": n})
