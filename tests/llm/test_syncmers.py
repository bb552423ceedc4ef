import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from almanac.llm import syncmers as Y

from .conftest import prose


def hash64(*values, seed=42):
    """The engine's hash of strings and longs; nulls are passed over."""
    for value in values:
        if value is not None:
            raw = value.encode() if isinstance(value, str) else value.to_bytes(8, "little",
                                                                               signed=True)
            seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def at(values, i):
    return values[i] if i < len(values) else None


def brute_force(text):
    pairs = [hash64(c, at(text, i + 1)) for i, c in enumerate(text)]
    smers = [hash64(p, at(pairs, i + 2)) for i, p in enumerate(pairs)]
    found = []
    for i in range(len(text)):
        window = smers[i:i + Y.WIDTH]
        if min(window) in (window[0], window[-1] if len(window) == Y.WIDTH else window[0]):
            mer = hash64(*[at(smers, i + k) for k in (*range(0, Y.WIDTH, Y.S), Y.WIDTH - 1)])
            found.append((i, mer & 0xFFFFFFFF))
    return found


def shown(found):
    return " ".join(f"{(place << 32) | value:X}" for place, value in found)


def jaccard(one, two):
    one, two = {h for _, h in one}, {h for _, h in two}
    return len(one & two) / len(one | two) if one | two else 1.0


def expected(rows):
    """Rows in the order of ids, highest first, null last, then by the digest of the text."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0),
                                       hashlib.sha256(r[1].encode()).hexdigest()))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        follower = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + follower[:cut]
        mine, theirs, other = (brute_force(t) for t in (text, edited, follower))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(mine),
                    shown(theirs), round(jaccard(mine, theirs), 9), round(jaccard(mine, other), 9)))
    return sorted(out, key=repr)


def actual(df):
    return sorted((tuple(r)[:5] + (round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=repr)


def test_messy_documents_equal_brute_force(messy):
    rows = [(r["doc_id"], r["text"] or "") for r in messy.select("doc_id", "text").collect()]
    assert actual(Y.fingerprint_documents(messy)) == expected(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 17])
def test_few_documents_in_many_blocks(spark, n):
    rows = [(10 * i, prose(i, 20)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert actual(Y.fingerprint_documents(docs)) == expected(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = actual(Y.fingerprint_documents(docs))
    assert got == expected(rows)
    assert sum(r[5] > r[6] for r in got) >= 0.95 * len(got)


def test_no_documents(no_documents):
    out = Y.fingerprint_documents(no_documents)
    assert out.count() == 0 and out.columns[0] == "doc_id"


def test_anchors_move_with_the_passage(spark):
    passage = prose(3, 60)
    docs = spark.createDataFrame([(passage, "x" * 57 + passage)], "a string, b string")
    found = [Y.anchors(Y.characters(F.col(c))) for c in "ab"]
    shared = docs.select(Y.shared_anchors(*found).alias("s")).first()["s"]
    moved = [s["there"] - s["here"] for s in shared]
    assert len(shared) > 20 and moved.count(57) >= 0.9 * len(moved)


def test_every_window_has_an_anchor(spark):
    text = prose(4, 200)
    places = [p for p, _ in brute_force(text)]
    assert max(b - a for a, b in zip(places, places[1:])) <= Y.WIDTH


def test_blocks_follow_the_bounds(spark):
    for n in (0, 1, 5, 40):
        bounds = sorted({(7 * i) % 1000 for i in range(n)}, reverse=True)
        keys = spark.range(-5, 1005, 9).select("id", Y._block_of(F.col("id"), bounds).alias("b"))
        assert all(r["b"] == sum(x > r["id"] for x in bounds) for r in keys.collect())


def test_small_tables_have_few_blocks(spark, monkeypatch):
    rows = spark.createDataFrame([("x" * 100,), (None,), ("é" * 100,)], "text string")
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 211)
        assert Y._blocks(rows) == 2 * cores and Y._blocks(rows.limit(0)) == 2 * cores
        monkeypatch.setattr(Y, "BLOCK_BYTES", 5)
        assert Y._blocks(rows) == 60
        monkeypatch.setattr(Y, "BLOCK_BYTES", 1)
        assert Y._blocks(rows) == 211
        spark.conf.set("spark.sql.shuffle.partitions", 3)
        assert Y._blocks(rows) == 3
        docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(90)], "doc_id long, text string")
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        monkeypatch.setattr(Y, "BLOCK_BYTES", 8_000_000)
        out = Y.fingerprint_documents(docs)
        assert out.rdd.getNumPartitions() <= 2 * cores
        assert actual(out) == expected([(i, prose(i, 20)) for i in range(90)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
