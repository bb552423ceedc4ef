"""What the operators share: written intermediates and row-wise Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.workload.scratch import scratch_dir


ROWS_IN_TASK = 16_384
BYTES_IN_TASK = 8_000_000
BYTES_IN_FILE = 512_000_000

_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)
_TASKS: ContextVar[int | None] = ContextVar("tasks", default=None)
_FILES: ContextVar[int | None] = ContextVar("files", default=None)


def written(df: DataFrame, name: str, keep: bool = False, codec: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage.

    Inside ``intermediates`` the table goes with the others, unless it is to be kept.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    tasks = _TASKS.get()
    if tasks is not None:
        df = df.coalesce(tasks)
    files = _FILES.get()
    if files is not None:
        df = df.repartition(files)
    df.write.option("compression", codec).parquet(path)
    folders = _FOLDERS.get()
    if folders is not None and not keep:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def tasks_for(rows: DataFrame, size: Column | None = None) -> Iterator[int]:
    """Tables written inside have no more files than a written table of ``rows`` asks for: one for
    each ``ROWS_IN_TASK``, and two for each core at least. Of many rows, as many as they have.

    With the ``size`` of a row in bytes, tables of small inputs are also gathered behind the tasks
    that work them out, into a file for each ``BYTES_IN_FILE`` or four times ``ROWS_IN_TASK``, two at
    least; inputs that ask for two such files for each core are not. Gives the number of tasks
    that rows of that size ask for.
    """
    least = 2 * rows.sparkSession.sparkContext.defaultParallelism
    n, total = rows.agg(F.count(F.lit(1)), F.lit(0) if size is None else F.sum(size)).first()
    tasks, total = max(least, -(-n // ROWS_IN_TASK)), total or 0
    files = max(2, -(-total // BYTES_IN_FILE), -(-n // (4 * ROWS_IN_TASK)))
    tokens = [(_TASKS, _TASKS.set(tasks)),
              (_FILES, _FILES.set(None if size is None or files >= least else files))]
    try:
        yield max(tasks, -(-total // BYTES_IN_TASK))
    finally:
        for variable, token in tokens:
            variable.reset(token)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written inside, once what needs them has been written too."""
    folders: list[str] = []
    token = _FOLDERS.set(folders)
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound variable."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the UTF-8 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(text_or_empty(column), 256))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of an Arrow batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
