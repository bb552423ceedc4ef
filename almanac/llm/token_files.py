"""Token ids of documents in files of compressed blocks, and back.

Documents are encoded, ranged by ``doc_id`` and written as parts of blocks; a part is one task's
range, a block a row of a Parquet file with its ids coded by ``rans.Table`` and what is in it: the
documents' ids and numbers of token ids. One table of frequencies, counted over all documents, lies
beside the parts. A document that has no room in a block starts the next one; only one that is longer
than a block is cut. Every block is read on its own, by any task.

Encoding goes through the distinct pieces of many texts. The tokenizer splits texts before it merges
and surely does so at some places (``_cuts``), so texts may be cut there and each distinct piece
encoded once. ``PieceEncoder`` checks that the file is of that kind, and takes texts with an added
token's string whole.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almanac.llm.base import intermediates, text_or_empty, written
from almanac.llm.rans import BadBlock, Layout, Table, scaled
from almanac.session import ship_package

#: One space and then characters that are no white space.
PLAIN = r"^ [!-~\x{C0}-\x{24F}\x{370}-\x{52F}]+$"
BYTES_AT_ONCE = 32_000_000
BYTES_IN_GROUP = 4_000_000
PIECES_IN_GROUP = 500_000
PIECES_IN_ROW = 1000
TEXTS_AT_ONCE = 64
LEAST_BITS = 18
BLOCK_SCHEMA = ("part int, block int, first long, n int, first_doc long, from_before boolean, "
                "goes_on boolean, doc_ids array<long>, sizes array<int>, data binary")
TABLE_SCHEMA = "bits int, frequencies binary"


def _row_groups(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Neighbouring rows of about ``most`` together, or none for 0; every row is in one group."""
    if not most or not len(sizes):
        return []
    nth = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(nth)) + 1).tolist(), len(sizes)]
    return list(zip(cuts, cuts[1:]))


#: Classes of bytes: letters, other visible ones, the apostrophe, which may begin a contraction, the
#: first bytes of characters that are surely no white space, and the space.
_LETTER, _SIGN, _APOSTROPHE, _LEAD, _SPACE, _LINE = 1, 2, 3, 4, 5, 6
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[[*range(0xC3, 0xE0), *range(0xE4, 0xEE), *range(0xF0, 0xF5)]] = _LEAD
_CLASS[[0x27, 0x20, 0x0A]] = _APOSTROPHE, _SPACE, _LINE


def _cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether the tokenizer surely begins a piece at a byte, and ends what it is in before it.

    That is so at a space before a visible character; behind a letter, where no letter follows;
    at a letter behind another visible character, but for the apostrophe; and at a letter behind a
    line end that a visible character precedes. A run of white space is cut nowhere else, as its
    pieces depend on what follows it.
    """
    kind = np.zeros(len(data) + 3, np.uint8)  # two unknown bytes before the data and one behind
    kind[2:-1] = _CLASS[data]
    latin = np.flatnonzero(data[:-1] == 0xC3)
    latin = latin[~np.isin(data[latin + 1], (0x97, 0xB7))]  # all but two of these are letters
    kind[latin + 2] = kind[latin + 3] = _LETTER
    last = bounds[1:][np.diff(bounds) > 0] - 1
    ends_with_space = last[data[last] == 0x20]
    before, here, after = kind[1:-2], kind[2:-1], kind[3:]
    visible = (after >= _LETTER) & (after <= _LEAD)
    cut = (here == _SPACE) & visible
    cut[ends_with_space] = False
    letter = before == _LETTER
    ascii_other = (here != _LETTER) & (data < 0x80)
    cut |= letter & ascii_other
    letter = here == _LETTER
    cut |= letter & (before == _SIGN)
    line = letter & (before == _LINE)
    cut[line] = (kind[:-3][line] >= _LETTER) & (kind[:-3][line] <= _APOSTROPHE)
    # The second byte of a letter isn't one's start.
    cut[latin + 1] = False
    return cut


def _places(marks: np.ndarray) -> np.ndarray:
    """Where the marks are, as 32-bit numbers, found in parts so that no wider ones are held."""
    out = np.empty(np.count_nonzero(marks), np.int32)
    at = 0
    for start in range(0, len(marks), BYTES_IN_GROUP):
        found = np.flatnonzero(marks[start:start + BYTES_IN_GROUP])
        out[at:at + len(found)] = found + start
        at += len(found)
    return out


class PieceEncoder:
    """Ids of texts by a tokenizers file, as packed integers of ``dtype``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.whole = [t["content"] for t in form["added_tokens"]]
        before = form["pre_tokenizer"] or {}
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and form["normalizer"] is None
            and form["truncation"] is None and form["padding"] is None)
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120")
                               for i in range(self.size)])

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        ids, sizes = [np.empty(0, self.dtype)], []
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(texts[start:start + TEXTS_AT_ONCE],
                                                      add_special_tokens=False):
                ids.append(np.array(e.ids, self.dtype))
                sizes.append(len(ids[-1]))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def _plain(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that have one space, in front. They are encoded in rows; each has one
        token that opens with a space, its first."""
        rows = ["".join(pieces[k:k + PIECES_IN_ROW]) for k in range(0, len(pieces), PIECES_IN_ROW)]
        ids, _ = self._library(rows)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(pieces):
            raise AssertionError("a piece without an opening token")
        return ids, np.diff(starts, append=len(ids))

    def _pieces(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """Parts of the texts that can be encoded alone, and where each text's begin and end."""
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][:len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds.astype(np.int64) - bounds[0]
        cut = np.zeros(len(data) + 1, bool)
        for i, j in _row_groups(np.diff(bounds), BYTES_IN_GROUP if self.by_word else 0):
            cut[bounds[i]:bounds[j]] = _cuts(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        for token in self.whole:
            for k in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)):
                cut[bounds[k]:bounds[k + 1]] = False
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        cut[-1] = True  # the end of the last piece
        places = _places(cut)
        pieces = pa.StringArray.from_buffers(
            len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
        return pieces, np.searchsorted(places[:-1], bounds.astype(np.int32))

    def encode(self, texts: pa.StringArray, end_id: int | None = None) -> pa.BinaryArray:
        """The packed ids of each text, and ``end_id`` behind them."""
        pieces, bounds = self._pieces(texts)
        coded = pieces.dictionary_encode()
        plain = pc.match_substring_regex(coded.dictionary, PLAIN)
        others = pc.invert(plain)
        end = [] if end_id is None else [end_id]
        # Distinct pieces, the plain ones first, and the end behind them.
        ids, sizes = (np.concatenate(x) for x in zip(
            self._plain(coded.dictionary.filter(plain).to_pylist()),
            self._library(coded.dictionary.filter(others).to_pylist()),
            (np.array(end, self.dtype), np.array([len(end)]))))
        plain = plain.to_numpy(zero_copy_only=False)
        item = np.where(plain, np.cumsum(plain) - 1, np.cumsum(~plain) - 1 + np.count_nonzero(plain))
        starts, order = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        out = [pa.array([], pa.binary())]
        for i, j in _row_groups(np.diff(bounds), PIECES_IN_GROUP):
            of = np.insert(item[order[bounds[i]:bounds[j]]], bounds[i + 1:j + 1] - bounds[i],
                           len(sizes) - 1)
            lengths = sizes[of]
            ends = np.cumsum(lengths)
            places = np.repeat(starts[of] - ends + lengths, lengths)
            places += np.arange(len(places))
            ends = np.append(0, ends[bounds[i + 1:j + 1] - bounds[i] + np.arange(j - i)])
            out.append(pa.Array.from_buffers(
                pa.binary(), j - i, [None, pa.py_buffer((ends * self.dtype.itemsize).astype(np.int32)),
                                     pa.py_buffer(ids[places])]))
        return pa.concat_arrays(out)


_LOADED: dict[str, PieceEncoder] = {}


def load(path: str) -> PieceEncoder:
    """The encoder of a file, made once per worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


def encoded_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, ids`` (packed, the end id last) and ``crc``, the checksum of the packed ids."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for i, j in _row_groups(sizes, BYTES_AT_ONCE):
                part = batch.slice(i, j - i)
                packed = encoder.encode(part.column(1), end_id)
                crcs = [zlib.crc32(ids.as_buffer()) for ids in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), packed, pa.array(crcs, pa.int64())], ["doc_id", "ids", "crc"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, ids binary, crc long")


def _packed_ids(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """All ids of a batch's rows in one array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def id_counts(encoded: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """How often each id occurs; as many rows as the vocabulary has come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(_packed_ids(batch.column(0), dtype), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for row in encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
            F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


class _Part:
    """Blocks of one part: documents come in order, full blocks go out."""

    def __init__(self, part: int, table: Table, layout: Layout):
        self.part, self.table, self.layout = part, table, layout
        self.block = self.first = self.doc = 0
        self._empty(from_before=False)

    def _empty(self, from_before: bool) -> None:
        self.ids: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.n, self.from_before = 0, from_before

    def _add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.n += len(ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.n + len(ids) > self.layout.block:
            yield from self.flush()
            while len(ids) > self.layout.block:
                self._add(doc_id, ids[:self.layout.block])
                yield from self.flush(goes_on=True)
                ids = ids[self.layout.block:]
        self._add(doc_id, ids)

    def flush(self, goes_on: bool = False) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        data = self.table.encode(np.concatenate(self.ids), self.layout)
        values = [self.part, self.block, self.first, self.n, self.doc, self.from_before, goes_on,
                  self.doc_ids, self.sizes, data]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(),
                 pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types)],
            [field.split()[0] for field in BLOCK_SCHEMA.split(", ")])
        self.block += 1
        self.first += self.n
        self.doc += len(self.doc_ids) - goes_on
        self._empty(from_before=goes_on)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int,
                      layout: Layout = Layout()) -> None:
    """Write the ids of every document, each with ``end_id`` behind it, to a new ``folder``.

    Order is by ``doc_id``, null last; rows of one id come by checksum and length of their ids. A
    null text has the end id only. Rows of a repeated id are spread over parts as any others. Other
    columns play no part; no documents give an empty table and no blocks. A text is encoded in one
    piece. The uncompressed ids are kept in the shared folder until the blocks are written.
    """
    encoder = load(path)
    with intermediates(docs.sparkSession):
        # The place tells equal rows apart, so that a frequent id can be ranged over several parts.
        rows = written(encoded_documents(docs, path, end_id).withColumn(
            "place", F.monotonically_increasing_id()), "token-ids", codec="zstd")
        counts = id_counts(rows, max(encoder.size, end_id + 1), encoder.dtype)
        bits = max(LEAST_BITS, int(np.count_nonzero(counts)).bit_length() + 2)
        table = Table(scaled(counts, bits), bits)
        spark, dtype = docs.sparkSession, encoder.dtype
        spark.createDataFrame(
            [(bits, bytearray(table.frequencies.astype("<u4").tobytes()))], TABLE_SCHEMA
        ).coalesce(1).write.parquet(f"{folder}/table")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = _Part(TaskContext.get().partitionId(), table, layout)
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield from part.add(doc_id, np.frombuffer(ids.as_buffer(), dtype))
            yield from part.flush()

        order = [F.col("doc_id").asc_nulls_last(), "crc", F.length("ids"), "place"]
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.select("doc_id", "ids").mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")


def read_table(spark: SparkSession, folder: str) -> Table:
    row = spark.read.schema(TABLE_SCHEMA).parquet(f"{folder}/table").first()
    return Table(np.frombuffer(row["frequencies"], "<u4").astype(np.int64), row["bits"])


def _times_x(power: int) -> int:
    """``x ** power`` modulo the checksum's polynomial, bits reflected."""
    out, square = 1 << 31, 1 << 30
    while power:
        if power & 1:
            out = _product(out, square)
        square = _product(square, square)
        power >>= 1
    return out


def _product(a: int, b: int) -> int:
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(one: int, two: int, n_bytes: int) -> int:
    """The crc32 of two byte strings in a row, of which the second has ``n_bytes``."""
    return _product(_times_x(8 * n_bytes), one) ^ two


def _pieces(blocks: DataFrame, table: Table, with_ids: bool) -> DataFrame:
    """A row per document and block: place, number of ids, their checksum and, as asked, the ids."""
    ship_package(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                try:
                    ids = table.decode(block["data"]).astype("<u4")
                except BadBlock as bad:
                    raise BadBlock(f"part {block['part']}, block {block['block']}: {bad}") from None
                sizes = block["sizes"]
                if sum(sizes) != len(ids) or len(ids) != block["n"]:
                    raise BadBlock(f"part {block['part']}, block {block['block']}: sizes")
                ends = list(accumulate(sizes))
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends, sizes)]
                columns = [
                    pa.array([block["part"]] * len(sizes), pa.int32()),
                    pa.array(range(block["first_doc"], block["first_doc"] + len(sizes)), pa.int64()),
                    pa.array([block["block"]] * len(sizes), pa.int32()),
                    pa.array(block["doc_ids"], pa.int64()),
                    pa.array([block["first"] + e - n for e, n in zip(ends, sizes)], pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array([0, *ends], pa.int32()), pa.array(ids.astype(np.int32))))
                names = ["part", "doc", "block", "doc_id", "first", "n", "crc"]
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    return blocks.mapInArrow(
        run, "part int, doc long, block int, doc_id long, first long, n long, crc long"
        + ", ids array<int>" * with_ids)


def _whole_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One checksum for each document out of those of its blocks."""
    for batch in batches:
        pieces = batch.column("pieces").to_pylist()
        crcs = []
        for (first, *rest) in pieces:
            crc = first["crc"]
            for piece in rest:
                crc = joined_crc(crc, piece["crc"], 4 * piece["n"])
            crcs.append(crc)
        at = batch.schema.get_field_index("pieces")
        yield batch.set_column(at, "ids_crc32", pa.array(crcs, pa.int64()))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, as asked, ``ids`` of every document in a folder.

    ``start`` is the number of ids before the document's in all files, ``ids_crc32`` the checksum of
    its decoded ids as little-endian unsigned 32-bit integers, both with the end id. A block that
    isn't whole, or belongs to another table, is an error that names it.
    """
    table = read_table(spark, folder)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    pieces = _pieces(blocks, table, with_ids)
    docs = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"),
        *[F.sort_array(F.collect_list(F.struct("block", "ids"))).alias("ids")] * with_ids)
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each part, of which there are as many as tasks wrote.
    offsets = blocks.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", (F.sum("n").over(running) - F.col("n")).alias("before"))
    placed = docs.join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "pieces",
        *[F.flatten("ids.ids").alias("ids")] * with_ids)
    return placed.mapInArrow(
        _whole_crcs, "doc_id long, start long, n_tokens long, ids_crc32 long"
        + ", ids array<int>" * with_ids)
