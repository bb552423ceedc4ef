"""Zipped wide tables. Unpacking and decoding are the only Python on the executors."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import ship_package

# --- fixed values -----------------------------------------------------------
ENCODINGS = ("cp932", "shift_jis", "utf-8-sig", "utf-8")
# ----------------------------------------------------------------------------

ROWS = """path string, member string, encoding string, row bigint,
          header array<string>, cells array<string>, error string"""
BATCH = 2_000
HEADER_ROW = -1


def _records(archive: zipfile.ZipFile, member: str, encoding: str) -> Iterator[list[str]]:
    with archive.open(member) as raw:
        text = io.TextIOWrapper(raw, encoding=encoding, errors="strict", newline="")
        for record in csv.reader(text):
            if record:
                yield record


def _readable(archive: zipfile.ZipFile, member: str, encoding: str) -> bool:
    """Whether the whole member decodes and no record is longer than the header."""
    try:
        records = _records(archive, member, encoding)
        width = len(next(records))
        return all(len(r) <= width for r in records)
    except (UnicodeError, csv.Error, StopIteration):
        return False


def _unique(names: list[str]) -> list[str]:
    """Repeated header names get a running number, so only the first one keeps its meaning."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        count = seen.get(name, 0)
        seen[name] = count + 1
        out.append(f"{name}.{count}" if count else name)
    return out


def _archive_rows(path: str, content: bytes, encodings: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    def failed(reason: str, member: str | None = None) -> pd.DataFrame:
        return pd.DataFrame([(path, member, None, None, None, None, reason)],
                            columns=["path", "member", "encoding", "row", "header", "cells",
                                     "error"])

    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        yield failed("not a zip archive")
        return
    with archive:
        member = next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)
        if member is None:
            yield failed("no CSV member")
            return
        encoding = next((e for e in encodings if _readable(archive, member, e)), None)
        if encoding is None:
            yield failed("no encoding reads the member", member)
            return
        records = _records(archive, member, encoding)
        header = _unique(next(records))
        batch: list[tuple] = [(path, member, encoding, HEADER_ROW, header, None, None)]
        for number, record in enumerate(records):
            cells = [c if c != "" else None for c in record]
            batch.append((path, member, encoding, number, header, cells, None))
            if len(batch) == BATCH:
                yield pd.DataFrame(batch, columns=failed("").columns)
                batch = []
        if batch:
            yield pd.DataFrame(batch, columns=failed("").columns)


def unpack_archives(files: DataFrame, encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """Records of the first CSV member of every archive in ``(path, content)``.

    Encodings are tried in order and the first that reads the whole member wins; members are
    streamed, never held as a whole. An archive that cannot be read is one row with ``error``; of
    any other the first row has the header and no cells.
    """
    ship_package(files.sparkSession)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                yield from _archive_rows(name, content, encodings)

    return files.select("path", "content").mapInPandas(unpack, ROWS)


def read_archives(spark: SparkSession, path: str,
                  encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """Records of the archives under ``path``; one archive may have up to 2 GB."""
    return unpack_archives(spark.read.format("binaryFile").load(path), encodings)


def archive_rejects(rows: DataFrame) -> DataFrame:
    """Archives without readable records or without month columns."""
    months = F.exists("header", lambda name: name.rlike(r"^\d{6}$"))
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(
        (F.col("row") == HEADER_ROW) & ~months, "no month columns")
    return rows.select("path", reason.alias("reason")).where("reason is not null")


def archive_records(rows: DataFrame) -> DataFrame:
    """The records of readable archives, without their headers' rows."""
    return rows.where(F.col("error").isNull() & (F.col("row") != HEADER_ROW))
