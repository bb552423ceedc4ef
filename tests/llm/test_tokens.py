import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from almanac.llm import token_cache
from almanac.llm.byte_bpe import ByteBpe, decode_ids, encode_documents, read_ranks
from almanac.workload.scratch import scratch_dir

from .conftest import texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = "ab éß漢😀\n\t  ▁'s1.é<s>"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(read_ranks(RANKS), public_tokenizers.PATTERN)


def ids_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_bpe_equals_the_library_on_documents(spark, library, bpe):
    for _, text in texts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        assert bpe.encode(text) == ids_of(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(HARD), max_size=60) | st.text(max_size=30))
def test_bpe_equals_the_library_on_any_text(library, bpe, text):
    ids = bpe.encode(text)
    assert ids == ids_of(library, text)
    assert bpe.decode(ids) == text.encode()


def test_bpe_is_linear_in_a_piece(library, bpe):
    for text in ("a" * 50_000, "ab" * 20_000, "é" * 20_000):
        assert bpe.decode(bpe.encode(text)).decode() == text
    assert bpe.encode("the" * 700) == ids_of(library, "the" * 700)


def test_small_vocabulary_with_an_unreachable_token():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abcd": 257}
    bpe = ByteBpe(ranks, r"\S+|\s+")
    assert bpe.encode_piece(b"abcd") == [257]  # the whole piece is a token
    assert bpe.encode_piece(b"abcde") == [256, 99, 100, 101]


def test_encode_documents(spark, messy, library):
    out = encode_documents(messy, RANKS, public_tokenizers.PATTERN)
    got = sorted((tuple(r[:4]) for r in out.collect()), key=repr)
    want = sorted(((d, len(ids_of(library, t)) // 4, hashlib.sha256(ids_of(library, t)).hexdigest(),
                    hashlib.sha256(t.encode()).hexdigest()) for d, t in texts(messy)), key=repr)
    assert got == want
    decoded = decode_ids(out, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in decoded) == sorted(t for _, t in texts(messy))


def test_no_documents_no_ids(no_documents):
    assert encode_documents(no_documents, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(HARD), max_size=40) | st.text(max_size=20))
def test_piece_counts_equal_the_library(text):
    counter = token_cache.load(MODEL)
    assert counter.by_word
    assert counter.count(text) == len(counter.model.encode(text))


def test_token_counts(messy):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted((tuple(r) for r in token_counts_of(messy).collect()), key=repr)
    want = []
    for doc_id, text in texts(messy):
        n = len(library.encode(text))
        want.append((doc_id, len(text.encode()), n, n > 4096))
    assert got == sorted(want, key=repr)


def token_counts_of(docs, cache=None):
    return token_cache.token_counts(docs, MODEL, cache)


def test_cache_keeps_counts_and_versions(spark, messy, monkeypatch):
    cache = token_cache.DigestCache(spark, scratch_dir(spark, "cache"))
    first = sorted((tuple(r) for r in token_counts_of(messy.limit(5), cache).collect()), key=repr)
    token_counts_of(messy, cache).count()
    stored = spark.read.parquet(cache.folder)
    distinct = len({t for _, t in texts(messy)})
    assert stored.count() == distinct  # each text was encoded once, in either run
    again = sorted((tuple(r) for r in token_counts_of(messy.limit(5), cache).collect()), key=repr)
    assert again == first and spark.read.parquet(cache.folder).count() == distinct
    monkeypatch.setattr(token_cache, "tokenizer_version", lambda path: b"other")
    token_counts_of(messy, cache).count()
    assert spark.read.parquet(cache.folder).count() == 2 * distinct


def test_no_documents_no_counts(no_documents):
    assert token_counts_of(no_documents).count() == 0
