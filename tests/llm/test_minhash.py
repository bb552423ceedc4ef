import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanac.llm.components import components
from almanac.llm.minhash import (
    NearDuplicates, keep_one, near_duplicate_classes, probability_jaccard, shingles, signatures,
)
from almanac.llm.queries import QUERIES

from .conftest import prose, texts


def sets_of(rows):
    out = []
    for _, text in rows:
        words = text.lower().split()
        out.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else {()})
    return out


def set_jaccard(x, y):
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def counted(text):
    words = text.lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def weighted_jaccard(x, y):
    """The definition, over all pairs of shingles."""
    x, y = ({s: 1 + math.log(n) for s, n in side.items()} for side in (x, y))
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys())
               for d in x.keys() & y.keys())


def brute_force(rows, alike=set_jaccard, sets=None):
    """Least id of each row's component of pairs with a similarity of 0.8."""
    sets, parent = sets or sets_of(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]) >= 0.8 - 1e-9:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def classes(df, by=NearDuplicates()):
    return sorted((tuple(r) for r in near_duplicate_classes(df, by).collect()), key=repr)


def edited(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return words


@pytest.fixture(scope="module")
def copies(spark):
    """A large group of near copies that don't all resemble each other, chains, exact copies."""
    rng = random.Random(5)
    base = [f"b{rng.randrange(5000)}" for _ in range(150)]
    rows = [(i, " ".join(edited(base, rng.randrange(6), rng))) for i in range(150)]
    chain = [f"c{rng.randrange(5000)}" for _ in range(200)]
    for i in range(200, 215):
        chain = edited(chain, 2, rng)
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join(base)) for i in range(300, 340)]
    shared = prose(9, 60)
    rows += [(i, shared + " " + " ".join(f"u{rng.random()}" for _ in range(60)))
             for i in range(400, 460)]
    rows += [(i, " ".join(f"s{rng.random()}" for _ in range(40))) for i in range(500, 520)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_classes_equal_brute_force(copies):
    assert classes(copies) == brute_force(texts(copies))


def test_small_blocks_lose_no_link(copies):
    assert classes(copies, NearDuplicates(block=16)) == brute_force(texts(copies))


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert classes(docs) == brute_force(texts(docs))


def test_messy_documents(messy):
    got = dict(classes(messy.where("doc_id is not null")))
    assert got[1] == got[2] == 1
    assert got[3] == got[4] == got[5] == got[11] == 3
    assert len(classes(messy)) == messy.count()
    kept = keep_one(messy)
    assert kept.columns == messy.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 3 in ids and 4 not in ids


def test_copies_whose_repeats_differ_are_linked(spark):
    """The shingle sets are equal; a footer is repeated twice in one copy, 300 times in the other."""
    rows = []
    for k in range(20):
        body = " ".join(f"b{k}x{i}" for i in range(80))
        footer = " ".join(f"f{k}x{i}" for i in range(20))
        rows += [(2 * k, " ".join([body, footer, footer])),
                 (2 * k + 1, " ".join([body, *[footer] * 300]))]
    assert dict(brute_force(rows)) == {i: i // 2 * 2 for i in range(40)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(docs) == brute_force(rows)


def repeating(rng, k):
    """A text, copies whose repeats differ a little or a lot, and one with an edit."""
    body = [f"b{k}x{i}" for i in range(70)]
    footer = [f"f{k}x{i}" for i in range(30)]
    changed = edited(body, 1, rng)
    return [" ".join(words) for words in (
        body + footer * 3, body + footer * 4, body + footer * 200, changed + footer * 3,
        edited(body, 12, rng) + footer * 200)]


def test_weighted_classes_equal_brute_force(spark):
    rng = random.Random(8)
    rows = list(enumerate(text for k in range(12) for text in repeating(rng, k)))
    want = brute_force(rows, weighted_jaccard, [counted(text) for _, text in rows])
    assert len({c for _, c in want}) > 12  # repeats alone part texts with equal sets
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by = NearDuplicates(weighted=True)
    assert classes(docs, by) == want
    assert {r["doc_id"] for r in keep_one(docs, by).collect()} == {c for _, c in want}


def test_query_and_pipeline_weigh_shingles(spark, tmp_path):
    rng = random.Random(3)
    rows = list(enumerate(text for k in range(6) for text in repeating(rng, k)))
    want = brute_force(rows, weighted_jaccard, [counted(text) for _, text in rows])
    assert want != brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_near_duplicates"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in kept} == {c for _, c in want}


def test_weighted_buckets_are_compared_in_blocks(spark):
    rng = random.Random(6)
    base = [f"b{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, " ".join(edited(base, rng.randrange(6), rng) + base[:10] * rng.randrange(1, 30)))
            for i in range(60)]
    want = brute_force(rows, weighted_jaccard, [counted(text) for _, text in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert classes(docs, NearDuplicates(weighted=True, block=16)) == want


def test_weighted_messy_documents(messy, no_documents):
    by = NearDuplicates(weighted=True)
    got = dict(classes(messy.where("doc_id is not null"), by))
    assert got[1] == got[2] == 1 and got[3] == got[4] == got[5] == got[11] == 3
    assert len(classes(messy, by)) == messy.count()
    assert classes(no_documents, by) == []


def test_probability_jaccard_equals_its_definition():
    rng = random.Random(4)
    for _ in range(60):
        x, y = ({rng.randrange(30): rng.randrange(1, 9) for _ in range(rng.randrange(1, 25))}
                for _ in range(2))
        one, two = (np.array(sorted(side), np.uint32) for side in (x, y))
        got = probability_jaccard(one, 1 + np.log([x[k] for k in one]),
                                  two, 1 + np.log([y[k] for k in two]))
        assert got == pytest.approx(weighted_jaccard(x, y))
        same = probability_jaccard(one, np.ones(len(one)), two, np.ones(len(two)))
        assert same == pytest.approx(set_jaccard(x.keys(), y.keys()))


def test_no_documents(no_documents):
    assert classes(no_documents) == []
    assert keep_one(no_documents).count() == 0


def test_keep_one_per_class(copies):
    want = {c for _, c in brute_force(texts(copies))}
    assert {r["doc_id"] for r in keep_one(copies).collect()} == want


def test_signatures_estimate_probability_jaccard():
    by = NearDuplicates()
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    one = [rng.choice(words) for _ in range(400)]
    _, doc, value, count = shingles([" ".join(one), " ".join(edited(one, 15, rng))], by)
    weight = 1 + np.log(count)
    weights = [dict(zip(value[doc == k], weight[doc == k])) for k in (0, 1)]
    common = weights[0].keys() & weights[1].keys()
    every = weights[0].keys() | weights[1].keys()
    exact = sum(1 / sum(max(weights[0].get(e, 0) / weights[0][d], weights[1].get(e, 0) / weights[1][d])
                        for e in every) for d in common)
    kept = signatures(2, doc, value, weight, 4000)
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.03


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert all(got[i] == 0 for i in [*range(41), 200]) and {got[i] for i in (100, 101, 102)} == {100}
    assert components(df.where(F.lit(False))).count() == 0


def test_small_tables_are_written_in_few_files(spark, monkeypatch, tmp_path):
    import almanac.llm.base as base

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(100).repartition(100)
    with base.tasks_for(rows):
        assert len(base.written(rows, "few").inputFiles()) <= 2 * cores
        assert base.written(rows, "few").count() == 100
    monkeypatch.setattr(base, "ROWS_IN_TASK", 1)
    with base.tasks_for(rows):
        assert len(base.written(rows, "many").inputFiles()) > 2 * cores
    assert len(base.written(rows, "many").inputFiles()) > 2 * cores
    monkeypatch.undo()
    written = []
    monkeypatch.setattr("almanac.llm.minhash.written", lambda df, name, **more: (
        written.append((name, base._TASKS.get())), base.written(df, name, **more))[1])
    docs = spark.createDataFrame([(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60))],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in near_duplicate_classes(docs).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]
    assert {t for name, t in written if name != "minhash-signed"} == {2 * cores}
    assert dict(written)["minhash-signed"] is None
