import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm.mtree import TreeSizes, build, search, top_k

SMALL = TreeSizes(routing=5, page_rows=40, query_rows=7, leaf_rows=8, fanout=3)


def brute_force(rows, k=5):
    usable = [(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows
              if i is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for query, q in sorted({(i, v) for i, v in usable if i % 50 == 0}):
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in usable
                  if i != query and len(v) == len(q)]
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def result(spark, rows, sizes=SMALL):
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows],
                               "vec_id long, embedding array<float>, pivot string, score double")
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, 5, sizes).collect())


def vectors(n, seed, dims=6):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((4, dims))
    return [(i, (centers[i % 4] + 0.3 * rng.standard_normal(dims)).astype("f4").tolist())
            for i in range(n)]


@pytest.mark.parametrize("sizes", [SMALL, TreeSizes()])
def test_equals_brute_force(spark, sizes):
    rows = vectors(400, 1)
    assert result(spark, rows, sizes) == brute_force(rows)


def test_ties_copies_nulls_and_lengths(spark):
    rows = vectors(120, 2)
    rows += [(1000 + i, [1.0] + [0.0] * 5) for i in range(200)]  # one very common vector
    rows += [(2000, None), (2050, [None] + [1.0] * 5), (2100, [float("nan")] * 6), (None, [1.0] * 6),
             (2150, [float("inf")] * 6), (2200, []), (2250, [0.5, 0.5]), (2251, [0.25, 0.5]),
             (7, [1.0] * 6), (7, [1.0] * 6), (50, [9.0] * 6)]
    rows = [r for r in rows if r[0] != 50] + [(50, [9.0] * 6)]
    assert result(spark, rows) == brute_force(rows)


def test_few_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(0, [1.0, 2.0])]) == []
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (100, [0.0, 0.0])]
    assert result(spark, rows) == brute_force(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-2**20, 2**20)) for _ in range(4)]) for i in range(60)]
    assert result(spark, rows) == brute_force(rows)


def test_bounds_spare_products():
    rng = np.random.default_rng(0)
    rows = np.round(rng.standard_normal((4, 8)) * 400)[np.arange(4000) % 4] + np.round(
        rng.standard_normal((4000, 8)) * 10)
    root = build(rows, np.arange(4000), rows[0], TreeSizes(leaf_rows=32))

    class Counted(np.ndarray):
        seen = 0

        def __matmul__(self, other):
            Counted.seen += len(self)
            return np.asarray(self) @ np.asarray(other)

    def count(node):
        node.vectors = node.vectors.view(Counted)
        for child in node.children:
            count(child)

    count(root)
    best = search(root, rows[0], rows[1], 1, 5, -np.inf)
    scores = rows @ rows[1]
    want = sorted(((s, -i) for i, s in enumerate(scores) if i != 1), reverse=True)[:5]
    assert sorted(best, reverse=True) == want
    assert Counted.seen < 0.5 * len(rows)
