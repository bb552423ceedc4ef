"""Near duplicates by ProbMinHash over word shingles, banding and verification.

Each shingle has a Poisson process with its weight as the rate, whose points fall on random
components of the signature; a component keeps the shingle with the earliest point. Points come
in order, so a shingle stops as soon as its next point is later than the latest component. Two texts
agree in a component with the probability Jaccard similarity of their weighted shingles, which
is the measure of bands, sketches and verification alike. ``NearDuplicates`` says what a shingle
weighs: by default the same however often it occurs, which makes this the Jaccard similarity of the
sets; or, ``weighted``, more the more often it occurs, so that texts which repeat other passages
resemble each other less.

Texts that are equal after normalisation are one node. Nodes that share a band are candidates:
first of each bucket's least and greatest node, which is linear in the rows and joins copies
of any number; then, in buckets that still hold several components, of all pairs of different
components, compared in blocks by sketches. Candidates are verified on all their shingles,
and verified links are joined to components.

Joins are sort-merge joins at every size, so that a small run shows what a large one costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import intermediates, tasks_for, text_digest, unused, written
from almanac.llm.components import components
from almanac.session import ship_package

CHARS_AT_ONCE = 100_000
ROWS_AT_ONCE = 256
CACHED_WORDS = 200_000
CACHED_CHARS = 64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearDuplicates:
    """A pair at the similarity is missed by the bands with a probability of
    ``(1 - similarity ** rows) ** bands``, 5e-5 by default; sketches of pairs pass from ``sketch``,
    four standard deviations below the similarity. ``weighted``: a shingle weighs 1 and the natural
    logarithm of its count in the text, instead of 1."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 25
    rows: int = 5
    sketch: float = 0.65
    block: int = 512
    weighted: bool = False

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def weights(self, counts: np.ndarray) -> np.ndarray:
        return 1 + np.log(counts) if self.weighted else np.ones(len(counts))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode())
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], by: NearDuplicates) -> tuple[list[bytes], np.ndarray, np.ndarray,
                                                           np.ndarray]:
    """Digests of the normalised texts; and of their distinct shingles the text's place, the hash
    and the count, sorted. Words are separated by white space, in lower case; a text with fewer
    words than a shingle has one shingle of all of them, one without words has none."""
    words = [np.fromiter(map(_WORDS.__getitem__, t.lower().split()), np.uint64) for t in texts]
    digests = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
    lengths = np.array([len(w) for w in words])
    flat = np.concatenate([*words, np.zeros(by.words, np.uint64)])
    counts = np.where(lengths == 0, 0, np.maximum(1, lengths - by.words + 1))
    doc = np.repeat(np.arange(len(texts)), counts)
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(lengths) - lengths, counts) + inside
    width = np.minimum(lengths, by.words)[doc]
    value = np.zeros(len(doc), np.uint64)
    for k in range(by.words):
        mixed = _mix(value * np.uint64(31) + flat[at + np.minimum(k, width - 1)] + GOLDEN)
        value = np.where(k < width, mixed, value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return digests, doc[first], value[first], np.diff(np.append(first, len(doc)))


def signatures(n: int, doc: np.ndarray, value: np.ndarray, weight: np.ndarray,
               size: int) -> np.ndarray:
    """ProbMinHash signatures of ``n`` texts: the shingle kept by each component."""
    earliest = np.full(n * size, np.inf)
    kept = np.zeros(n * size, np.uint64)
    counts = np.bincount(doc, minlength=n)
    for few, part in ((16, counts[doc] < size), (1, counts[doc] >= size)):
        d, v, w = doc[part], value[part], weight[part]
        x, step = np.zeros(len(d)), 0
        while len(d):
            numbers = np.arange(step + 1, step + few + 1, dtype=np.uint64)
            bits = _mix(v[:, None] + numbers * GOLDEN)
            uniform = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            points = x[:, None] + np.cumsum(-np.log(uniform) / w[:, None], axis=1)
            component = ((_mix(bits + GOLDEN) >> np.uint64(32)) * np.uint64(size)
                         >> np.uint64(32)).astype(np.int64)
            slot = (d[:, None] * size + component).ravel()
            np.minimum.at(earliest, slot, points.ravel())
            won = points.ravel() == earliest[slot]
            kept[slot[won]] = np.repeat(v, few)[won]
            x, step = points[:, -1], step + few
            latest = earliest.reshape(n, size).max(axis=1)
            alive = x < latest[d]
            d, v, w, x = d[alive], v[alive], w[alive], x[alive]
    return kept.reshape(n, size)


def _band_hashes(kept: np.ndarray, by: NearDuplicates) -> np.ndarray:
    value = np.tile(np.arange(by.bands, dtype=np.uint64), (len(kept), 1))
    for k in range(by.rows):
        value = _mix(value * np.uint64(31) + kept[:, k::by.rows] + GOLDEN)
    return value.view(np.int64)


def probability_jaccard(one: np.ndarray, of_one: np.ndarray, two: np.ndarray,
                        of_two: np.ndarray) -> float:
    """The similarity of two weighted sets: distinct elements and their weights.

    An element d of both counts 1 / sum of max(x(e) / x(d), y(e) / y(d)) over all e. By falling
    x(e) / y(e), the first part of the order up to d takes the left term and the rest the right.
    """
    every = np.union1d(one, two)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, one)] = of_one
    y[np.searchsorted(every, two)] = of_two
    order = np.argsort(-x / (x + y), kind="stable")
    x, y = x[order], y[order]
    before, behind = np.cumsum(x), y.sum() - np.cumsum(y)
    both = (x > 0) & (y > 0)
    return float((1 / (before[both] / x[both] + behind[both] / y[both])).sum())


def _packed(value: np.ndarray, count: np.ndarray, by: NearDuplicates) -> bytes:
    """Distinct 32-bit hashes of shingles, sorted; behind them their counts if these matter."""
    small, first = np.unique((value >> np.uint64(32)).astype(np.uint32), return_index=True)
    if not by.weighted:
        return small.tobytes()
    return small.tobytes() + np.add.reduceat(count, first).astype(np.uint32).tobytes()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of characters, or one text."""
    sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > CHARS_AT_ONCE:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def signed(docs: DataFrame, by: NearDuplicates) -> DataFrame:
    """``doc_id, text_digest, node`` of every row, and of the first with its node in a task also
    ``bands, sketch, shingles`` (see ``_packed``). Written once, for all later steps."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in _slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                nodes, doc, value, count = shingles(texts, by)
                kept = signatures(len(texts), doc, value, by.weights(count), by.size)
                bands = _band_hashes(kept, by)
                sketch = _mix(kept).astype(np.uint8)
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                rows = []
                for at, node in enumerate(nodes):
                    ours = slice(ends[at], ends[at + 1])
                    if node in seen or ends[at] == ends[at + 1]:
                        rows.append((None, None, None))
                        continue
                    seen.add(node)
                    rows.append((bands[at], sketch[at].tobytes(),
                                 _packed(value[ours], count[ours], by)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_digest"), pa.array(nodes),
                     pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.binary())],
                    ["doc_id", "text_digest", "node", "bands", "sketch", "shingles"])
        # The worker goes on to other tasks, of other operators too.
        _WORDS.clear()
        pa.default_memory_pool().release_unused()

    return written(
        docs.select("doc_id", text_digest().alias("text_digest"), "text").mapInArrow(
            run, f"doc_id {kind}, text_digest binary, node binary, bands array<bigint>, "
                 "sketch binary, shingles binary"), "minhash-signed")


def _with_key_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in the written table of distinct ``keys``.

    A bitmap of the keys' hashes goes over the rows before they are shuffled. Its size follows the
    number of keys up to 32 MB; it may let others through, which the join drops.
    """
    bits = 1 << min(28, max(15, (16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    bitmap = keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap"))
    at = F.bitmap_bit_position(F.col("_place"))
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(at / 8) + 1).cast("int"), 1)), 16, 10)
    known = byte.cast("int").bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    likely = (
        rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
        .join(F.broadcast(bitmap), "_bucket").where(known).select(*rows.columns)
    )
    return likely.join(keys.hint("merge"), key, "left_semi")


def _of_nodes(contents: DataFrame, ends: DataFrame, column: str) -> DataFrame:
    """``node`` and a column of the distinct ``ends``."""
    nodes = written(ends.distinct(), "minhash-wanted")
    found = _with_key_in(contents.select("node", column), nodes, "node")
    return written(found.dropDuplicates(["node"]), f"minhash-{column}")


def _sketches_agree(x: bytes, y: bytes, by: NearDuplicates) -> bool:
    same = np.count_nonzero(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8))
    return same >= by.sketch * by.size


def _shingles_agree(x: bytes, y: bytes, by: NearDuplicates) -> bool:
    one, two = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    if by.weighted:
        (one, of_one), (two, of_two) = np.split(one, 2), np.split(two, 2)
        return probability_jaccard(one, by.weights(of_one), two, by.weights(of_two)
                                   ) >= by.similarity - 1e-9
    if min(len(one), len(two)) < by.similarity * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both >= by.similarity * (len(one) + len(two) - both) - 1e-9


def verified(pairs: DataFrame, contents: DataFrame, by: NearDuplicates) -> DataFrame:
    """The pairs ``(a, b)`` whose shingles have the similarity, by sketch first."""
    def passing(pairs: DataFrame, column: str, agree) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        wanted = _of_nodes(contents, ends, column)
        left = wanted.withColumnsRenamed({"node": "a", column: "of_a"})
        right = wanted.withColumnsRenamed({"node": "b", column: "of_b"})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(start, ROWS_AT_ONCE)
                    both = zip(part.column("of_a").to_pylist(), part.column("of_b").to_pylist())
                    keep = pa.array([agree(x, y, by) for x, y in both], pa.bool_())
                    yield part.select(["a", "b"]).filter(keep)

        return written(
            pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
            .select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary"), f"minhash-by-{column}")

    return passing(passing(pairs, "sketch", _sketches_agree), "shingles", _shingles_agree)


def _star_pairs(banded: DataFrame, buckets: DataFrame) -> DataFrame:
    """Each node with the least and the greatest node of its buckets."""
    met = banded.join(buckets.hint("merge"), "band")
    ends = [met.where(F.col("node") != F.col(end)).select(
        F.least("node", end).alias("a"), F.greatest("node", end).alias("b"))
        for end in ("first", "last")]
    return written(ends[0].union(ends[1]).distinct(), "minhash-pairs")


class _Group:
    """The nodes of one bucket in a pair of blocks."""

    def __init__(self, rows: list[dict], by: NearDuplicates):
        self.by, self.rows = by, rows
        self.sides = [[r for r in rows if r["block"] == rows[0][k]] for k in ("i", "j")]
        self.one_block = rows[0]["i"] == rows[0]["j"]

    def candidates(self) -> Iterator[tuple[float, dict, dict]]:
        """Pairs of different components with agreeing sketches, in their first common band."""
        left, right = self.sides
        if not left or not right:
            return
        width = self.by.size
        sketches = np.frombuffer(b"".join(r["sketch"] for r in right), np.uint8).reshape(-1, width)
        bands = np.array([r["bands"] for r in right])
        place = int(np.flatnonzero(np.array(left[0]["bands"]) == left[0]["band"])[0])
        for row in left:
            same = (sketches == np.frombuffer(row["sketch"], np.uint8)).sum(axis=1)
            fit = same >= self.by.sketch * width
            fit &= ~(bands[:, :place] == np.array(row["bands"])[:place]).any(axis=1)
            for at in np.flatnonzero(fit):
                other = right[at]
                if other["label"] != row["label"] and (
                        not self.one_block or row["node"] < other["node"]):
                    yield int(same[at]), row, other

    def links(self) -> Iterator[tuple[bytes, bytes]]:
        """Verified links, the likeliest first; none inside what they have joined already."""
        parent: dict[bytes, bytes] = {}

        def root(label: bytes) -> bytes:
            while label in parent:
                label = parent[label]
            return label

        for _, a, b in sorted(self.candidates(), key=lambda c: (-c[0], c[1]["node"], c[2]["node"])):
            one, two = root(a["label"]), root(b["label"])
            if one != two and _shingles_agree(a["shingles"], b["shingles"], self.by):
                parent[one] = two
                yield min(a["node"], b["node"]), max(a["node"], b["node"])


def _grouped(batches: Iterator[pa.RecordBatch], by: NearDuplicates) -> Iterator[_Group]:
    rows = (row for batch in batches for start in range(0, batch.num_rows, ROWS_AT_ONCE)
            for row in batch.slice(start, ROWS_AT_ONCE).to_pylist())
    for _, group in groupby(rows, key=lambda r: (r["band"], r["i"], r["j"])):
        yield _Group(list(group), by)


def _open_links(banded: DataFrame, labels: DataFrame, contents: DataFrame,
                by: NearDuplicates) -> DataFrame | None:
    """Links between different components in buckets with more than three nodes.

    Smaller buckets have been compared in full. A bucket is compared in blocks of bounded size, each
    pair of blocks on its own: first by sketches, to find the nodes that have any candidate;
    then, with the shingles of those, to verify. Pairs stay inside the task, links come out.
    """
    labelled = banded.join(labels.hint("merge"), "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label"))
    labelled = written(labelled, "minhash-labelled")
    unsolved = labelled.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("one"), F.max("label").alias("other"))
    unsolved = written(unsolved.where("n > 3 and one <> other").select(
        "band", F.ceil(F.col("n") / by.block).cast("int").alias("blocks")), "minhash-open")
    if unsolved.isEmpty():
        return None
    rows = written(labelled.join(unsolved.hint("merge"), "band").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "minhash-rows")
    short = contents.withColumn("short", F.struct("sketch", "bands"))
    rows = rows.join(_of_nodes(short, rows.select("node"), "short").hint("merge"), "node").select(
        "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "block",
        "node", "label", "short.sketch", "short.bands")
    rows = rows.withColumn("i", F.least("block", "other")).withColumn(
        "j", F.greatest("block", "other")).drop("other")
    key = ["band", "i", "j"]
    columns = ["band", "i", "j", "block", "node", "label", "sketch", "bands"]

    def with_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("band", pa.int64()), ("i", pa.int32()), ("j", pa.int32()),
                            ("block", pa.int32()), ("node", pa.binary()), ("label", pa.binary()),
                            ("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))])
        for group in _grouped(batches, by):
            found = {r["node"]: r for _, a, b in group.candidates() for r in (a, b)}
            if found:
                yield pa.RecordBatch.from_pylist(list(found.values()), schema=schema)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, by):
            links = list(group.links())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], ["a", "b"])

    def dealt(frame: DataFrame, *more: str) -> DataFrame:
        return frame.select(*columns, *more).repartition(*key).sortWithinPartitions(*key)

    kept = written(dealt(rows).mapInArrow(
        with_candidates, "band bigint, i int, j int, block int, node binary, label binary, "
                         "sketch binary, bands array<bigint>"), "minhash-candidates")
    sets = _of_nodes(contents, kept.select("node"), "shingles")
    return written(dealt(kept.join(sets.hint("merge"), "node"), "shingles").mapInArrow(
        linked, "a binary, b binary").distinct(), "minhash-more")


def _classes(rows: DataFrame, by: NearDuplicates) -> DataFrame:
    """``node, label`` of the nodes that have links."""
    contents = rows.where("bands is not null")
    banded = contents.select("node", F.explode("bands").alias("band"))
    buckets = written(
        banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where(F.col("first") != F.col("last")), "minhash-buckets")
    shared = written(_with_key_in(banded, buckets.select("band"), "band").distinct(),
                     "minhash-banded")
    pairs = _star_pairs(shared, buckets)
    links = verified(pairs, contents, by)
    labels = components(links)
    more = _open_links(shared, labels, contents, by)
    if more is None or more.isEmpty():
        return labels
    return components(links.union(more))


def near_duplicate_classes(docs: DataFrame, by: NearDuplicates = NearDuplicates()) -> DataFrame:
    """``doc_id, class_id`` of every row: the least ``doc_id`` of its class.

    Texts that differ in case or white space only are one class, whatever their length. Null and
    empty texts are one class, too. Repeated rows are copies of each other; a class of rows without
    ``doc_id`` has a null class. Other columns play no part; no documents give no rows.
    """
    with intermediates(docs.sparkSession):
        rows = signed(docs, by)
        with tasks_for(rows, F.octet_length("shingles")):
            classes = _numbered(rows, _classes(rows, by))
            return written(rows.select("doc_id", "node").join(classes.hint("merge"), "node").select(
                "doc_id", "class_id"), "minhash-result", keep=True)


def _numbered(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, class_id`` of every node."""
    least = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = written(least.join(labels.hint("merge"), "node", "left").withColumn(
        "label", F.coalesce("label", "node")), "minhash-nodes")
    least = nodes.groupBy("label").agg(F.min("least").alias("class_id"))
    return written(nodes.join(least.hint("merge"), "label").select("node", "class_id"),
                   "minhash-classes")


def keep_one(docs: DataFrame, by: NearDuplicates = NearDuplicates()) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: the one with the least ``doc_id``,
    and of several such rows the one with the least digest of its text."""
    with intermediates(docs.sparkSession):
        rows = signed(docs, by)
        with tasks_for(rows, F.octet_length("shingles")) as tasks:
            labels = _classes(rows, by)
            classed = rows.join(labels.hint("merge"), "node", "left").select(
                F.coalesce("label", "node").alias("label"), F.struct(
                    F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                    F.col("text_digest").alias("digest")).alias("row"))
            kept = written(
                classed.groupBy("label").agg(F.min("row").alias("row")).select(
                    F.col("row.id").alias("kept_id"), F.col("row.digest").alias("kept_digest")),
                "minhash-kept", keep=True)
    digest, place = unused(docs, "row_digest"), unused(docs, "row_place")
    same = Window.partitionBy("doc_id", digest).orderBy(F.lit(1))
    first = (
        docs.withColumn(digest, text_digest())
        .withColumn(place, F.row_number().over(same)).where(F.col(place) == 1)
    )
    return first.join(kept.hint("merge"), first["doc_id"].eqNullSafe(F.col("kept_id"))
                      & (first[digest] == F.col("kept_digest")), "left_semi").select(
        *docs.columns).coalesce(tasks)
