"""How the sources of a language differ, by exact integer divergences of their term counts.

Terms are runs of letters; a language keeps those in at least ``least`` of its documents. A group
(a language's source) gives each kept term a share of 10 ** 9, smoothed by one; two groups differ at
a term by ``(p - q) ** 2 // q``, and by the sum over all kept terms, the absent ones too.

Sums are made by pair tasks. A group's terms are sorted ``(term id, count)`` arrays, cut into blocks
of terms by a hash, so that no array grows with the vocabulary. A co-group brings together the arrays
of two tiles of sources; each unordered pair in it is merged by a galloping intersection that prices
the terms of both, of one side and, by the number of terms that neither has, of none, in both
directions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import text_or_empty, written
from almanac.session import ship_package

#: Bytes that stand in no term become spaces, and A-Z its small letters.
FOLDED = bytes(0x20 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
               else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
TERMS_HELD = 600_000
BLOCK_ROWS = 262_144
TILE = 16
GALLOP = 512
PAIR_SCHEMA = "lang string, one string, two string, forth long, back long, either long"


@dataclass(frozen=True)
class Audit:
    """Terms in fewer than ``least`` documents of a language play no part; ``top`` terms a group."""

    least: int = 3
    top: int = 200


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of a task's documents, and a row without a term per group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (n + 1)), pa.array([source] * (n + 1)),
                pa.array([None, *counts], pa.binary()).view(pa.string()),
                pa.array([0, *counts.values()], pa.int64()),
                pa.array([0, *map(docs.__getitem__, counts)], pa.int64()),
            ], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for key, text in zip(keys, batch.column(2)):
            if key not in groups:
                groups[key] = Counter(), Counter()
            counts, docs = groups[key]
            words = text.as_py().translate(FOLDED).split()
            counts.update(words)
            docs.update(set(words))
        if sum(len(counts) for counts, _ in groups.values()) >= TERMS_HELD:
            yield from rows()
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``; each group has one row with a null term."""
    ship_package(docs.sparkSession)
    read = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"),
                       text_or_empty().cast("binary").alias("text"))
    counted = read.mapInArrow(
        _count_terms, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _kept_terms(counts: DataFrame, blocks: int, least: int) -> DataFrame:
    """``lang, block, id, term, source, n, lang_n`` of the kept terms; ids are dense in a block."""
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    of_term = Window.partitionBy("lang", "block", "term")
    in_order = Window.partitionBy("lang", "block").orderBy("term")
    return (
        counts.where("term is not null")
        .withColumn("block", block)
        .repartition("lang", "block")
        .withColumn("lang_docs", F.sum("docs").over(of_term))
        .withColumn("lang_n", F.sum("n").over(of_term))
        .where(F.col("lang_docs") >= least)
        .select("lang", "block", F.dense_rank().over(in_order).alias("id"), "term", "source", "n",
                "lang_n")
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """``1 + 10 ** 9 * (count + 1) // total`` in three steps of long division, within 64 bits."""
    rest = count + 1
    out = _div(rest, total)
    for _ in range(3):
        rest = (rest % total) * 1000
        out = out * 1000 + _div(rest, total)
    return out + 1


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``share`` of an array."""
    out, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + more
    return out + 1


def _difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _group_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, terms, tile, tiles`` of every group.

    The totals are those of the kept terms' counts plus the number of kept terms, one at least.
    """
    groups = counts.where("term is null").select("lang", "source")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = (
        kept.groupBy("lang", "block").agg(F.max("id").alias("terms"), F.sum("n").alias("lang_n"))
        .groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("lang_n").alias("lang_n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    last = F.max("tile").over(Window.partitionBy("lang"))
    none = F.lit(0).cast("long")
    return (
        groups.join(sums, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("terms", none).alias("terms"),
                F.greatest(F.coalesce("n", none) + F.coalesce("terms", none), F.lit(1))
                .alias("total"),
                F.greatest(F.coalesce("lang_n", none) + F.coalesce("terms", none), F.lit(1))
                .alias("lang_total"),
                F.floor(place / TILE).cast("int").alias("tile"))
        .withColumn("tiles", last + 1)
    )


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the common ids of two sorted arrays without repeats.

    Ids of the shorter one go in chunks; for each, the bound in the longer one doubles from where the
    last chunk ended until it is past the chunk, and the ids are searched in between.
    """
    places = np.empty(len(short), np.int64)
    low = 0
    for start in range(0, len(short), GALLOP):
        chunk = short[start:start + GALLOP]
        step = len(chunk)
        while low + step < len(long) and long[low + step] < chunk[-1]:
            step *= 2
        places[start:start + GALLOP] = low + np.searchsorted(long[low:low + step + 1], chunk)
        low = int(places[start + len(chunk) - 1])
    inside = places < len(long)
    inside[inside] = long[places[inside]] == short[inside]
    mine = np.flatnonzero(inside)
    return mine, places[mine]


@dataclass(frozen=True)
class _Terms:
    """One group's terms of a block: ids, shares, and the share of a term that it lacks."""

    source: str
    ids: np.ndarray
    p: np.ndarray
    absent: int


def _read_terms(table: pa.Table) -> list[_Terms]:
    out = []
    for batch in table.combine_chunks().to_batches():
        lists = batch.column("terms")
        flat = lists.flatten()
        ids, counts = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        totals = batch.column("total").to_pylist()
        for k, source in enumerate(batch.column("source").to_pylist()):
            of = slice(int(ends[k]), int(ends[k + 1]))
            out.append(_Terms(source, ids[of], shares(counts[of], totals[k]),
                              int(shares(np.zeros(1, np.int64), totals[k])[0])))
    return sorted(out, key=lambda t: t.source)


def price_pair(one: _Terms, two: _Terms) -> tuple[int, int, int]:
    """``one`` against ``two`` over the terms of either, the other way round, and their number."""
    if len(one.ids) > len(two.ids):
        back, forth, either = price_pair(two, one)
        return forth, back, either
    mine, theirs = gallop(one.ids, two.ids)
    only_mine, only_theirs = np.ones(len(one.ids), bool), np.ones(len(two.ids), bool)
    only_mine[mine] = False
    only_theirs[theirs] = False
    p = np.concatenate([one.p[mine], one.p[only_mine],
                        np.full(len(two.ids) - len(theirs), one.absent)])
    q = np.concatenate([two.p[theirs], np.full(len(one.ids) - len(mine), two.absent),
                        two.p[only_theirs]])
    square = (p - q) ** 2
    return int((square // q).sum()), int((square // p).sum()), len(p)


def _merge_tiles(left: pa.Table, right: pa.Table) -> pa.Table:
    """All unordered pairs of a block between two tiles, or within one that comes alone."""
    own, others = _read_terms(left), _read_terms(right)
    if others:
        pairs = [(a, b) for a in own for b in others]
    else:
        pairs = [(a, b) for k, a in enumerate(own) for b in own[k + 1:]]
    rows = [(a.source, b.source, *price_pair(a, b)) for a, b in pairs]
    columns = list(zip(*rows)) or [()] * 5
    lang = (left if left.num_rows else right).column("lang")[0].as_py()
    return pa.table([
        pa.array([lang] * len(rows), pa.string()), pa.array(columns[0], pa.string()),
        pa.array(columns[1], pa.string()), *[pa.array(c, pa.int64()) for c in columns[2:]],
    ], names=["lang", "one", "two", "forth", "back", "either"])


def _pair_sums(kept: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """``PAIR_SCHEMA``: both differences of each pair over the terms that either has."""
    every = groups.select("lang", "source", F.explode(
        F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(None).cast("int").alias("id"), F.lit(None).cast("long").alias("n"))
    arrays = (
        kept.select("lang", "source", "block", "id", "n").union(every)
        .groupBy("lang", "block", "source")
        .agg(F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("id", "n"))))
             .alias("terms"))
        .join(groups.select("lang", "source", "total", "tile", "tiles"), ["lang", "source"])
    )
    columns = ["lang", "block", "i", "j", "source", "total", "terms"]
    left = arrays.withColumnRenamed("tile", "i").withColumn(
        "j", F.explode(F.expr("sequence(i, tiles - 1)"))).select(columns)
    right = arrays.where("tile > 0").withColumnRenamed("tile", "j").withColumn(
        "i", F.explode(F.expr("sequence(0, j - 1)"))).select(*[F.col(c).alias(c) for c in columns])
    key = ["lang", "block", "i", "j"]
    return (
        left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_merge_tiles, PAIR_SCHEMA)
        .groupBy("lang", "one", "two")
        .agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"),
             F.sum("either").alias("either"))
    )


def _pair_values(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every pair in both directions, absent terms included."""
    absent = groups.select("lang", "source", "terms",
                           share(F.lit(0).cast("long"), F.col("total")).alias("p"))
    one = absent.withColumnsRenamed({"source": "one", "p": "p_one"})
    two = absent.drop("terms").withColumnsRenamed({"source": "two", "p": "p_two"})
    none = F.col("terms") - F.col("either")
    p, q = F.col("p_one"), F.col("p_two")
    both = F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item"),
                 (F.col("forth") + none * _difference(p, q)).alias("value")),
        F.struct(F.col("two").alias("source"), F.col("one").alias("item"),
                 (F.col("back") + none * _difference(q, p)).alias("value")))
    return sums.join(one, ["lang", "one"]).join(two, ["lang", "two"]).select(
        "lang", F.inline(both))


def _term_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that a group has more of than its language."""
    return (
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"),
                share(F.col("n"), F.col("total")).alias("p"),
                share(F.col("lang_n"), F.col("lang_total")).alias("q"))
        .where("p > q")
        .select("lang", "source", "item", _difference(F.col("p"), F.col("q")).alias("value"))
    )


def audit_sources(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group.

    Part ``pair`` has each other source of the language with the group's difference from it, part
    ``term`` the ``top`` terms of which the group has more than its language, with theirs. Ranks go by
    value, highest first, then by the item's bytes. A null text, language or source counts as an
    empty one; every row is a document, repeated ones too. A group without terms is compared as any
    other; a language without kept terms has differences of 0, and one with a single source
    no pairs. Other columns play no part. Values are exact while a language has under 9 * 10 ** 15
    words and 10 ** 9 kept terms.
    """
    counts = written(term_counts(docs), "audit-counts")
    blocks = max(1, -(-counts.count() // BLOCK_ROWS))
    kept = written(_kept_terms(counts, blocks, audit.least), "audit-terms")
    groups = written(_group_totals(counts, kept), "audit-groups")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(part: str, values: DataFrame) -> DataFrame:
        return values.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                             F.row_number().over(by_value).alias("rank"))

    terms = ranked("term", _term_values(kept, groups)).where(F.col("rank") <= audit.top)
    return ranked("pair", _pair_values(_pair_sums(kept, groups, blocks), groups)).union(terms)
