"""Byte-level BPE by backtracking over longest matches, exact and linear in the text.

Bytes are read as Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary finds
the longest token at every place in one pass. The encoder goes from left to right with the longest
match; a token is taken if its pair with the one before it is what the merges would leave standing
(memoised), otherwise its longest proper prefix is tried, and where nothing fits the place is
marked and the token before it gives way. Each place is given up once at most.

A pair stands if undoing the merges of both sides, from the latest rank down, never shows a merge
across the border that the ranks would have made earlier.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.base import texts_of
from almanac.session import ship_package

CACHE_PIECES = 250_000
CACHE_PAIRS = 400_000
CACHED_BYTES = 64
ROWS_AT_ONCE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


def _merged(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts of a token before its last merge, by merging the lowest rank first."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], len(ranks)), i)
                       for i in range(len(parts) - 1))
        if rank == len(ranks):
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Encoder and decoder over a table of ranks, which has every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.whole: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            parts = [token] if len(token) == 1 else _merged(token, ranks)
            if len(token) > 1 and len(parts) != 2:
                continue  # no merges lead to it; only a piece that equals it becomes this token
            self.left[rank], self.right[rank] = ranks[parts[0]], ranks[parts[-1]]
            if len(token) > 1:
                self.whole[self.left[rank], self.right[rank]] = rank
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.shorter = {rank: self._prefix(self.bytes_of[rank]) for rank in self.left}
        self.memo: dict[int, bool] = {}
        self.cache = _PieceCache(self)

    def _prefix(self, token: bytes) -> int | None:
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end])
            if rank in self.left:
                return rank
        return None

    def _stands(self, one: int, two: int) -> bool:
        """Whether the merges leave the border between two neighbouring tokens alone."""
        limit = len(self.ranks) + 1
        while True:
            joined = self.whole.get((one, two))
            if joined is not None and joined < limit:
                return False
            undo_one = one > two
            for _ in range(2):
                if undo_one:
                    limit, one = one, self.right[one]
                    if one != limit:
                        break
                else:
                    limit, two = two + 1, self.left[two]
                    if two + 1 != limit:
                        break
                undo_one = not undo_one
            else:
                return True

    def compatible(self, one: int, two: int) -> bool:
        pair = one << 32 | two
        known = self.memo.get(pair)
        if known is None:
            if len(self.memo) >= CACHE_PAIRS:
                self.memo.clear()
            known = self.memo[pair] = self._stands(one, two)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ranks of one match of the pattern."""
        if not piece:
            return []
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [(0, 0)] * len(piece)
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - match[0]
            if match[0] > longest[start][0]:
                longest[start] = match
        out: list[int] = []
        given_up = bytearray(len(piece) + 1)
        at, token = 0, longest[0][1]
        while at < len(piece):
            while token is not None:
                end = at + len(self.bytes_of[token])
                if not given_up[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                given_up[at] = 1
                last = out.pop()
                at -= len(self.bytes_of[last])
                token = self.shorter[last]
            else:
                out.append(token)
                at = end
                token = longest[at][1] if at < len(piece) else None
        return out

    def encode(self, text: str) -> bytes:
        """The ranks of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _PieceCache(dict):
    """Ranks by piece. Long pieces aren't kept, and a full cache starts anew."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = self.bpe.encode_piece(raw)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file, built once per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = True,
                     decode: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256`` and, as asked, ``decoded_sha256`` and ``ids``.

    ``path`` is the rank file, which every executor can read there. The decoded bytes are made
    from the ids. A null text is encoded as an empty one, which has no tokens; rows are
    independent, so repeated rows give repeated results; other columns play no part.
    """
    ship_package(docs.sparkSession)
    schema = ("doc_id long, n_tokens long, ids_sha256 string"
              + ", decoded_sha256 string" * decode + ", ids array<long>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                packed = [bpe.encode(t) for t in texts_of(part)]
                columns = [part.column("doc_id").cast(pa.int64()),
                           pa.array([len(ids) // 4 for ids in packed], pa.int64()),
                           pa.array([hashlib.sha256(ids).hexdigest() for ids in packed])]
                if decode:
                    columns.append(pa.array(
                        [hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in packed]))
                if with_ids:
                    columns.append(pa.array(
                        [np.frombuffer(ids, "<u4").astype(np.int64) for ids in packed],
                        pa.list_(pa.int64())))
                names = ["doc_id", "n_tokens", "ids_sha256"] + ["decoded_sha256"] * decode
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (binary) of ``(doc_id, ids)``; null ids give no bytes."""
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], "<u4").tobytes())
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        run, "doc_id long, decoded binary")
