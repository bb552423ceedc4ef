"""Token counts through a cache keyed by content and tokenizer digests.

Documents are joined to stored counts by the digest of their normalised text and of the tokenizer
file. Texts without a stored count are encoded once each and appended to the cache, so a
second run over the same texts encodes nothing, and a new tokenizer version doesn't meet the
counts of the old one.

Counting a text goes word by word with a memo. That is exact for a model in which no piece has a
word mark behind another character and which normalises nothing: no merge crosses the place before
a run of spaces, nor a line end. ``PieceCounter`` checks the model and else encodes whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.session import ship_package
from almanac.workload.scratch import scratch_dir

MARK = "▁"
CACHED_WORDS = 500_000
CACHED_CHARS = 64
PARTITION_BYTES = 64 * 1024 * 1024
CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens long"


class _Counts(dict):
    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


class PieceCounter:
    """Numbers of pieces that a sentencepiece model makes of texts."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = "ﬁ\t ａ　\n é  x"
        self.by_word = (
            not any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in pieces)
            and self.model.normalize(probe) == MARK + probe.replace(" ", MARK))
        self.after_space = _Counts(self._after_space)
        self.after_line_end = _Counts(self._after_line_end)

    def _whole(self, text: str) -> int:
        return len(self.model.encode(text))

    def _after_space(self, word: str) -> int:
        """Pieces of a word and the mark before it, which the model adds by itself."""
        return self._whole(word) if word else 1

    def _after_line_end(self, word: str) -> int:
        """Pieces of a word that has no mark, as it is behind a line end."""
        return self._whole("\n" + word) - 2

    def _spaced(self, spaces: int, word: str) -> int:
        """Pieces of a run of marks and the word behind it."""
        if spaces == 1:
            return self.after_space[word]
        return self._whole(" " * (spaces - 1) + word)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self._whole(text)
        lines = text.replace(MARK, " ").split("\n")
        total = len(lines) - 1
        for at, line in enumerate(lines):
            if at == 0:
                line = " " + line
            if "  " in line or line.endswith(" "):
                for run in re.findall(" *[^ ]+| +", line):
                    word = run.lstrip(" ")
                    spaces = len(run) - len(word)
                    total += self._spaced(spaces, word) if spaces else self.after_line_end[word]
                continue
            first, *words = line.split(" ")
            if first:
                total += self.after_line_end[first]
            total += sum(map(self.after_space.__getitem__, words))
        return total


_LOADED: dict[str, PieceCounter] = {}


def load(path: str) -> PieceCounter:
    if path not in _LOADED:
        _LOADED[path] = PieceCounter(path)
    return _LOADED[path]


def tokenizer_version(path: str) -> bytes:
    """SHA-256 of the tokenizer file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).digest()


def content_digest(text: Column) -> Column:
    """Of the normalised text. The model normalises nothing, so only null becomes empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop texts that the task has sent on already, so that copies don't meet in one task."""
    seen: set[bytes] = set()
    for batch in batches:
        digests = batch.column("digest").to_pylist()
        new = []
        for digest in digests:
            new.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(new, pa.bool_()))


def count_misses(texts: DataFrame, path: str) -> DataFrame:
    """``digest, tokenizer, n_tokens`` of the distinct ``(digest, text)``, each encoded once."""
    ship_package(texts.sparkSession)
    version = tokenizer_version(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in _first_of_task(batches):
            counts = [counter.count(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").cast(pa.binary()), pa.array([version] * batch.num_rows),
                 pa.array(counts, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    first = texts.select("digest", "text").mapInArrow(_first_of_task, "digest binary, text string")
    return first.repartition("digest").mapInArrow(run, CACHE_SCHEMA)


class DigestCache:
    """Stored counts in a folder that driver and executors share; runs append to it."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        """One row per digest and tokenizer version, also if two runs stored the same."""
        empty = self.spark.createDataFrame([], CACHE_SCHEMA)
        if self._exists():
            empty = self.spark.read.schema(CACHE_SCHEMA).parquet(self.folder)
        return empty.groupBy("digest", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))

    def _exists(self) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return system.exists(path)

    def append(self, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self.folder)


def token_counts(docs: DataFrame, path: str, cache: DigestCache | None = None,
                 limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    Without ``cache`` a new one is made in the shared folder. A null text counts as an empty one
    (0 bytes, 0 tokens). Copies are encoded once; repeated rows have a result each. Other
    columns play no part; no documents give no rows and leave an empty cache.
    """
    spark = docs.sparkSession
    if cache is None:
        cache = DigestCache(spark, scratch_dir(spark, "token-cache"))
    version = tokenizer_version(path)
    content = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                          content_digest(F.col("text")).alias("digest"))
    stored = cache.read().where(F.col("tokenizer") == F.lit(version))
    misses = content.select("digest", "text")
    if cache._exists():
        misses = misses.join(stored.select("digest"), "digest", "left_anti")
    cache.append(count_misses(misses, path))
    stored = cache.read().where(F.col("tokenizer") == F.lit(version))
    sizes = content.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return sizes.join(stored, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
