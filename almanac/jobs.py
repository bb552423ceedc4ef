"""Spark jobs that don't wait for each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import Any

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = Lock()
# By session: how many are inside of shuffles_removed, and the setting before the first of them.
_INSIDE: dict[str, tuple[int, str]] = {}


def at_once(spark: SparkSession, *actions: Callable[[], Any]) -> list[Any]:
    """Results of actions that run side by side, so that one's last tasks don't leave the
    executors idle. All of them end before the first error, in the given order, is raised."""
    with ThreadPoolExecutor(max(1, len(actions))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [each.result() for each in running]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action inside go when it ends. Else they stay on the executors' disks until
    the driver happens to collect its garbage, which may be after a run's last job."""
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        inside, before = _INSIDE.get(session, (0, spark.conf.get(CLEANUP, "false")))
        _INSIDE[session] = inside + 1, before
        spark.conf.set(CLEANUP, True)
    try:
        yield
    finally:
        with _LOCK:
            inside, before = _INSIDE.pop(session)
            if inside > 1:
                _INSIDE[session] = inside - 1, before
            else:
                spark.conf.set(CLEANUP, before)
