import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from almanac.llm import rans
from almanac.llm import token_files as T
from almanac.llm.queries import token_files_query

from .conftest import prose, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
END = 2
PIECES = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "'", "'s", " 're", "'LL", "a", "The", " word", "é", "ÿ",
          "×", "÷", "ß", "x²", "²", "½", "7", "42 ", "!", "...", " ", "　", " ", "\u0085", "\x1c",
          "\x1f", "\x00", "漢字", "かな", "😀", "é", "​", "﻿", "_", "<|endoftext|>", "<|", "Ж",
          "ﬁ", "Ⅷ", " ", "᠎", "`", "{", "Ġ"]


def by_library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    """Rows in the order of ids, null last; equal ids by checksum and length of their ids."""
    coded = [(doc_id, by_library(text) + [END]) for doc_id, text in rows]
    coded.sort(key=lambda r: (r[0] is None, r[0] or 0, zlib.crc32(np.array(r[1], "<u2").tobytes()),
                              len(r[1])))
    out, start = [], 0
    for doc_id, ids in coded:
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=5))
def test_encoder_is_the_library(parts):
    encoder = T.load(PATH)
    assert encoder.by_word
    got = encoder.encode(pa.array(parts, pa.string()), END)
    assert [np.frombuffer(g.as_buffer(), "<u2").tolist() for g in got] == [
        by_library(t) + [END] for t in parts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4))
def test_encoder_on_any_text(parts):
    got = T.load(PATH).encode(pa.array(["skipped", *parts], pa.string())[1:])
    assert [np.frombuffer(g.as_buffer(), "<u2").tolist() for g in got] == [
        by_library(t) for t in parts]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=80))
def test_checksums_join(one, two):
    assert T.joined_crc(zlib.crc32(one), zlib.crc32(two), len(two)) == zlib.crc32(one + two)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 700), st.integers(0, 3000), st.integers(0, 10**6),
       st.sampled_from([(1, 1), (4, 3), (64, 16), (1024, 128)]))
def test_blocks_round_trip(size, n, seed, shape):
    ids = np.random.default_rng(seed).zipf(1.2, n) % size
    counts = np.bincount(ids, minlength=size)
    table = rans.Table(rans.scaled(counts, 12), 12)
    assert n == 0 or table.frequencies.sum() == 1 << 12
    assert ((table.frequencies > 0) == (counts > 0)).all()
    layout = rans.Layout(10**6, *shape)
    data = table.encode(ids, layout)
    assert table.decode(data).tolist() == ids.tolist()
    segment = layout.lanes_for(n) * layout.stride
    for k in range(0, -(-n // segment), 3):
        assert table.decode(data, k, k + 2).tolist() == ids[k * segment:(k + 2) * segment].tolist()


def test_size_is_near_the_entropy():
    ids = np.random.default_rng(1).zipf(1.3, 200_000) % 5000
    counts = np.bincount(ids)
    table = rans.Table(rans.scaled(counts, 18), 18)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum()
    assert len(table.encode(ids)) * 8 / len(ids) < 1.02 * entropy + 0.6


def test_bad_blocks_are_told():
    table = rans.Table(rans.scaled(np.array([5, 0, 9]), 12), 12)
    data = table.encode(np.array([0, 2, 2, 0]))
    for at in range(len(data)):
        with pytest.raises(rans.BadBlock):
            table.decode(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:])
    with pytest.raises(rans.BadBlock):
        table.decode(data[:-1])
    with pytest.raises(rans.BadBlock):
        rans.Table(rans.scaled(np.array([5, 1, 9]), 12), 12).decode(data)
    with pytest.raises(ValueError):
        table.encode(np.array([1]))


def files(spark, docs, tmp_path, **layout):
    folder = f"{tmp_path}/{os.urandom(4).hex()}"
    T.write_token_files(docs, PATH, folder, END, rans.Layout(**layout))
    return folder


def test_documents_of_every_kind(spark, messy, tmp_path):
    rows = texts(messy)
    got = T.read_token_files(spark, files(spark, messy, tmp_path)).collect()
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == expected(rows)
    coded = sorted(((i, by_library(t) + [END]) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == coded


def test_no_documents(spark, no_documents, tmp_path):
    folder = files(spark, no_documents, tmp_path)
    assert T.read_token_files(spark, folder).collect() == []
    assert T.read_table(spark, folder).frequencies.sum() == 0


def test_documents_over_many_blocks_and_parts(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, prose(k, rng.choice([0, 3, 40, 900]))) for k in range(60)]
    rows += [(7, prose(100 + k, 30)) for k in range(40)] + [(7, "same")] * 40 + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = files(spark, docs, tmp_path, block=256, lanes=8, stride=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.where("goes_on").count() > 5 and blocks.select("part").distinct().count() > 1
    assert blocks.where("n > 256").count() == 0
    got = T.read_token_files(spark, folder).collect()
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == expected(rows)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_a_bad_file_is_told(spark, tmp_path):
    folder = files(spark, spark.createDataFrame([(1, "some text")], "doc_id long, text string"),
                   tmp_path)
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/blocks").collect()]
    data = bytearray(rows[0]["data"])
    data[30] ^= 4
    rows[0]["data"] = data
    other = f"{tmp_path}/other"
    spark.createDataFrame(rows, T.BLOCK_SCHEMA).write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{other}/table")
    with pytest.raises(Exception, match="part 0, block 0: checksum"):
        T.read_token_files(spark, other).collect()


def test_query_by_the_library(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60)))) for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = token_files_query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == expected(rows)


def test_places_are_found_in_parts(monkeypatch):
    marks = np.random.default_rng(1).random(1000) < 0.3
    monkeypatch.setattr(T, "BYTES_IN_GROUP", 7)
    for some in (marks, marks[:0], marks[:7], marks[:8]):
        found = T._places(some)
        assert found.dtype == np.int32 and found.tolist() == np.flatnonzero(some).tolist()
