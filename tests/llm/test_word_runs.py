import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from almanac.llm import word_runs as W
from almanac.llm.queries import word_runs_query
from .conftest import texts


def runs_by_comparing(words, least=6, exponent=4):
    """Every period's maximal stretches; a stretch has the least of its periods."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_comparing(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def split(text):
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


def test_cover_reaches_every_difference():
    cover = W.difference_cover(13)
    assert len(cover) == 4
    assert {(a - b) % 13 for a in cover for b in cover} == set(range(13))
    for a in range(W.MODULUS):
        for b in range(W.MODULUS):
            assert {(a + W.SHIFT[a, b]) % W.MODULUS, (b + W.SHIFT[a, b]) % W.MODULUS} <= set(W.COVER)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 4), st.integers(0, 10**6)),
                min_size=1, max_size=4))
def test_extensions_are_those_of_comparing(shapes):
    docs = [[random.Random(seed + k).randint(1, 1 + letters) for k in range(n)]
            for n, letters, seed in shapes]
    words = np.array([0] + [w for d in docs for w in d + [0]])
    extensions = W.Extensions(words)
    rng, start = random.Random(len(words)), 1
    for d in docs:
        for _ in range(20 if len(d) > 1 else 0):
            a, b = sorted(rng.sample(range(len(d)), 2))
            n = 0
            while b + n < len(d) and d[a + n] == d[b + n]:
                n += 1
            got = extensions.common(np.array([start + a]), np.array([start + b]))
            assert got.tolist() == [n]
        start += len(d) + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 6), st.integers(0, 10**6),
                          st.integers(1, 40)), min_size=1, max_size=4),
       st.sampled_from([(6, 4), (2, 2), (9, 3)]))
def test_runs_are_those_of_comparing(shapes, bounds):
    docs = []
    for n, letters, seed, period in shapes:
        rng = random.Random(seed)
        words = [b"w%d" % rng.randint(0, letters) for _ in range(n)]
        first = rng.randint(0, n)
        docs.append(words[:first] + [words[first + i % period] if first + i % period < n else b"x"
                                     for i in range(n - first)])
    for words, runs in zip(docs, W._slice_runs(docs, *bounds)):
        assert list(map(tuple, runs.tolist())) == runs_by_comparing(words, *bounds)


def test_long_periodic_texts():
    block = [b"w%d" % (i * i % 997) for i in range(2000)]
    docs = [block * 5, [b"same"] * 30_000, block, [b"a", b"b"] * 9 + [b"a"]]
    runs = [list(map(tuple, r.tolist())) for r in W._slice_runs(docs, 6, 4)]
    period = next(q for q in range(1, 2001) if block * 2 == (block * 2)[q:] + (block * 2)[:q]
                  and (block * 5)[q:] == (block * 5)[:-q])
    assert runs[0] == [(0, 10_000, period)]
    assert runs[1] == [(0, 30_000, 1)]
    assert runs[3] == [(0, 19, 2)]


def test_documents_of_every_kind(spark, messy):
    got = {}
    for r in W.word_runs(messy).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts(messy):
        words = split(text)
        runs = runs_by_comparing(words) if len(words) < 3000 else None
        for r in got[doc_id]:
            if runs is not None and doc_id is not None:
                assert r["n_words"] == len(words)
                assert [tuple(x) for x in r["runs"]] == runs
                assert r["collapsed"] == collapsed_by_comparing(words, runs)
    assert sum(map(len, got.values())) == messy.count()
    assert got[10][0]["collapsed"] == "line"
    assert got[9][0]["collapsed"] == "漢字かな交じり文。 😀 é"


def test_no_documents(no_documents):
    assert W.word_runs(no_documents).collect() == []


def test_one_period_is_no_run(messy):
    with pytest.raises(ValueError):
        W.word_runs(messy, exponent=1)


def test_query_by_comparing(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, None if i == 3 else " ".join(
        rng.choice(["a", "b", "c\n", "ü"]) for _ in range(rng.choice([0, 1, 9, 60, 200]))))
        for i in range(120)] + [(7, "x y"), (None, "b b b b b b b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        words = split(text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = runs_by_comparing(words)
        s, length, q = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        digest = "".join(f"{x},{y},{z}\n" for x, y, z in runs)
        expected.append((doc_id, len(runs), s, length, q, q and 1000 * length // q,
                         hashlib.sha256(digest.encode()).hexdigest(),
                         hashlib.sha256(collapsed_by_comparing(words, runs).encode()).hexdigest()))
    got = [tuple(r) for r in word_runs_query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert any(r[1] for r in got) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got)
