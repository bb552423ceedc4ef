"""Exact top-k inner products by best-first search in M-trees.

Rows are dealt to the nearest of a bounded number of routing objects and, where a routing object
has many rows, on to pages of bounded size. Each page is an M-tree: nodes hold routing vectors with
covering radii and the distances to their parent. For a query ``q``, a routing vector ``c`` and any
row ``x`` below it, the triangle inequality gives ``q.x <= q.c + |q| r``; and with the parent ``p``,
``q.c <= q.p + |q| d(c, p)``, so that most ``q.c`` needn't be computed.

The scores of the routing objects, which are rows themselves, give each query a first bound, with
which it skips the pages that can't hold one of its best rows. Queries meet pages in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import written
from almanac.session import ship_package

EXACT = 2.0 ** 53


@dataclass(frozen=True)
class TreeSizes:
    """``routing`` objects at the root are a sample by hash; every row is searched or proven out."""

    routing: int = 64
    page_rows: int = 8192
    query_rows: int = 4096
    leaf_rows: int = 256
    fanout: int = 16


def quantised(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    return F.when(usable, F.transform(
        vector, lambda x: F.floor(F.lit(256.0) * x.cast("double"))))


def _matrix(vectors) -> np.ndarray:
    """Rows as float64 where all products are exact in it, else as integers."""
    rows = np.array([np.asarray(v, np.int64) for v in vectors], np.int64)
    most = float(np.abs(rows.astype(np.float64)).max(initial=0))
    return rows.astype(np.float64) if most * most * max(1, rows.shape[1]) < EXACT else rows


def _distances(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    gap = rows.astype(np.float64) - center.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    rows, centers = rows.astype(np.float64), centers.astype(np.float64)
    return (np.einsum("ij,ij->i", centers, centers)[None, :] - 2 * rows @ centers.T).argmin(axis=1)


@dataclass
class Node:
    """Entries are rows in a leaf, else routing vectors; ``parent`` has their parent distances."""

    vectors: np.ndarray
    parent: np.ndarray
    ids: np.ndarray | None = None
    radii: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)


def build(vectors: np.ndarray, ids: np.ndarray, center: np.ndarray, sizes: TreeSizes) -> Node:
    """The M-tree of a page below the routing vector ``center``, loaded from the top."""
    if len(ids) <= sizes.leaf_rows:
        return Node(vectors, _distances(vectors, center), ids)
    seeds = vectors[np.linspace(0, len(ids) - 1, sizes.fanout).astype(int)]
    near = _nearest(vectors, seeds)
    if np.bincount(near).max() == len(ids):  # nothing tells the rows apart
        near = np.arange(len(ids)) * sizes.fanout // len(ids)
    used = np.unique(near)
    parts = [near == k for k in used]
    return Node(
        seeds[used], _distances(seeds[used], center),
        radii=np.array([_distances(vectors[p], seeds[k]).max() for k, p in zip(used, parts)]),
        children=[build(vectors[p], ids[p], seeds[k], sizes) for k, p in zip(used, parts)])


def search(root: Node, center: np.ndarray, query: np.ndarray, query_id: int, k: int,
           least: float) -> list[tuple[int, int]]:
    """The ``k`` best ``(score, -vec_id)`` below the root that reach ``least``, in any order."""
    length = float(np.sqrt(np.dot(query.astype(np.float64), query.astype(np.float64))))
    slack = 1.0 + 1e-9 * length
    best: list[tuple[int, int]] = []
    open_nodes = [(-np.inf, 0, root, float(center @ query))]
    pushed = 0
    while open_nodes:
        bound, _, node, to_parent = heapq.heappop(open_nodes)
        if -bound + slack < least:
            break
        reach = node.parent if node.ids is not None else node.parent + node.radii
        keep = np.flatnonzero(to_parent + length * reach + slack >= least)
        if not len(keep):
            continue
        scores = node.vectors[keep] @ query
        if node.ids is None:
            bounds = scores + length * node.radii[keep]
            for at in np.flatnonzero(bounds + slack >= least):
                pushed += 1
                heapq.heappush(open_nodes, (-float(bounds[at]), pushed, node.children[keep[at]],
                                            float(scores[at])))
            continue
        reached = np.flatnonzero(scores >= least)
        ids = node.ids[keep[reached]]
        for score, vec_id in zip(scores[reached].tolist(), ids.tolist()):
            entry = (int(score), -vec_id)
            if vec_id == query_id:
                continue
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
        if len(best) == k:
            least = max(least, best[0][0])
    return best


def _deal_rows(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with the nearest routing object of their dimension and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column("v").to_pylist())
            near = _nearest(matrix, pivots) if batch.num_rows else np.array([], int)
            distance = _distances(matrix, pivots[near]) if batch.num_rows else np.array([])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(near, pa.int32()),
                 pa.array(distance, pa.float64())], ["vec_id", "v", "pivot", "distance"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, pivot int, distance double")


def _top_of_dimension(rows: DataFrame, is_query: Column, k: int, sizes: TreeSizes) -> DataFrame:
    spark = rows.sparkSession
    chosen = rows.orderBy(F.xxhash64("v"), "vec_id").limit(sizes.routing).collect()
    pivots = _matrix([r["v"] for r in chosen])
    pivot_ids = np.array([r["vec_id"] for r in chosen])
    dealt = written(_deal_rows(rows, pivots), "mtree-rows")
    known = {r["pivot"]: (r["radius"], r["n"]) for r in dealt.groupBy("pivot").agg(
        F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    pages = {p: -(-n // sizes.page_rows) for p, (_, n) in known.items()}
    queries = rows.where(is_query).distinct()
    blocks = max(1, -(-queries.count() // sizes.query_rows))
    page_count = F.create_map(*[F.lit(x) for item in pages.items() for x in item])
    paged = dealt.select(
        "vec_id", "v", "pivot",
        F.pmod(F.xxhash64("vec_id"), page_count[F.col("pivot")].cast("long")).cast("int")
        .alias("page"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.array(sorted(known))
        radii = np.array([known[p][0] for p in order])
        for batch in batches:
            out: list[tuple] = []
            for query_id, vector in zip(batch.column("vec_id").to_pylist(),
                                        batch.column("v").to_pylist()):
                q = np.asarray(vector, pivots.dtype)
                scores = pivots @ q
                others = np.sort(scores[pivot_ids != query_id])[::-1]
                least = float(others[k - 1]) if len(others) >= k else -np.inf
                bounds = scores[order] + np.sqrt(float(q @ q)) * radii
                for at in np.flatnonzero(bounds + 1.0 + 1e-9 * np.abs(bounds) >= least):
                    for page in range(pages[int(order[at])]):
                        out.append((query_id, vector, int(order[at]), page, least))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("vec_id", "v", "pivot", "page", "least"), r)) for r in out],
                schema=pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())),
                                  ("pivot", pa.int32()), ("page", pa.int32()),
                                  ("least", pa.float64())]))

    routed = queries.mapInArrow(
        route, "vec_id long, v array<long>, pivot int, page int, least double"
    ).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    key = ["pivot", "page", "block"]

    def search_page(group: tuple, page: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if page.empty or asked.empty:
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        both = _matrix([*page["v"], *asked["v"], pivots[group[0]]])
        vectors, wanted, center = both[:len(page)], both[len(page):-1], both[-1]
        root = build(vectors, page["vec_id"].to_numpy(), center, sizes)
        found = [(q, -i, s) for row, q, least in zip(wanted, asked["vec_id"], asked["least"])
                 for s, i in search(root, center, row, q, k, least)]
        return pd.DataFrame(found, columns=columns).astype("int64")

    return (
        paged.groupBy(*key).cogroup(routed.groupBy(*key))
        .applyInPandas(search_page, "query_id long, vec_id long, score long")
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5,
          sizes: TreeSizes = TreeSizes()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` highest scores.

    ``is_query`` is a condition on ``vec_id``. Scores are integer inner products of quantised
    vectors, ties go to the smaller ``vec_id``; rows with the query's own id are not its candidates.
    Rows with a null id, and vectors that are null or hold a null or non-finite component, take no
    part; vectors are compared with those of their own length, and each length has a tree. A
    repeated row is a candidate each time and one query. Other columns play no part.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = written(
        vectors.select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("v"))
        .where("vec_id is not null and v is not null"), "mtree-vectors")
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().collect()]
    found = None
    for length in sorted(lengths):
        part = _top_of_dimension(rows.where(F.size("v") == length), is_query, k, sizes)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
