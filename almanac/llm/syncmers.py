"""Document fingerprints of closed syncmers, native expressions only.

A closed syncmer is a k-mer of characters whose least inner s-mer, by hash, is its first or last
one. Whether a k-mer is one depends on nothing else, so that equal passages have equal anchors
wherever they stand, and any ``k - s + 1`` neighbouring k-mers have one. At the end of a text
the k-mers are cut off and start with their least s-mer, so that a text of any length but 0 has an
anchor.

An anchor is a number: its place in the upper, the hash of its k-mer in the lower 32 bits. A
fingerprint lists these numbers in hexadecimal, so the last eight digits are the hash. The likeness of
two fingerprints is the Jaccard similarity of their hashes; ``shared_anchors`` gives their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import let, text_or_empty

S, WIDTH = 4, 16
K = S + WIDTH - 1
BLOCK_BYTES = 8_000_000
LEAST_ID = -(1 << 63)
HASH = 0xFFFFFFFF


def _at(place: Column) -> Column:
    """A place as the upper half of an anchor."""
    return F.shiftleft(place.cast("long"), 32)


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.size(values))


def _paired(values: Column, by: int, body) -> Column:
    """``body`` of each element and the one ``by`` places behind it, null behind the end."""
    return F.zip_with(values, _shifted(values, by), body)


def _chain(value: Column, *bodies) -> Column:
    """Hand a value on from body to body, each evaluated once."""
    for body in bodies[:-1]:
        value = let(value, body)
    return let(value, bodies[-1])


def characters(text: Column) -> Column:
    """The code points of a text as an array."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def anchors(chars: Column, offset: Column | int = 0) -> Column:
    """The anchors of the closed syncmers of an array of characters, as an array of numbers."""

    def joined(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def least_of(by: int):
        return lambda m: _paired(m, by, lambda a, b: F.least(a, b))

    def selected(smers: Column) -> Column:
        def anchor(least: Column, i: Column) -> Column:
            last = F.get(smers, i + (WIDTH - 1))  # null behind the end
            mer = F.xxhash64(*[F.get(smers, i + at) for at in (*range(0, WIDTH, S), WIDTH - 1)])
            return F.when((least == F.get(smers, i)) | (least == last), _at(i + offset).bitwiseOR(
                mer.bitwiseAND(F.lit(HASH))))

        minima = _chain(smers, *[least_of(1 << step) for step in range(WIDTH.bit_length() - 1)])
        return let(minima, lambda m: F.array_compact(F.transform(m, anchor)))

    return _chain(chars, lambda c: _paired(c, 1, joined), lambda p: _paired(p, 2, joined), selected)


def fingerprint(found: Column) -> Column:
    """The anchors as text; of no text, the empty one."""
    return F.array_join(F.transform(found, lambda a: F.hex(a)), " ")


def hashes_of(found: Column) -> Column:
    """The distinct hashes of anchors."""
    return F.array_distinct(F.transform(found, lambda a: a.bitwiseAND(F.lit(HASH))))


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""
    return let(F.size(F.array_intersect(one, two)), lambda both: F.coalesce(
        both / F.nullif(F.size(one) + F.size(two) - both, F.lit(0)), F.lit(1.0)))


def shared_anchors(one: Column, two: Column) -> Column:
    """``array<struct<hash, here, there>>``: the first places of the anchors that two have."""

    def first_places(found: Column) -> Column:
        return F.aggregate(
            found, F.create_map().cast("map<bigint,int>"),
            lambda seen, a: F.when(F.map_contains_key(seen, a.bitwiseAND(F.lit(HASH))), seen).otherwise(
                F.map_concat(seen, F.map_from_arrays(
                    F.array(a.bitwiseAND(F.lit(HASH))), F.array(F.shiftright(a, 32).cast("int"))))))

    return let(first_places(one), lambda here: let(first_places(two), lambda there: F.transform(
        F.array_intersect(F.map_keys(here), F.map_keys(there)), lambda h: F.struct(
            h.alias("hash"), here[h].alias("here"), there[h].alias("there")))))


def edited_anchors(found: Column, of_tail: Column, text: Column, head: Column,
                   tail: Column) -> Column:
    """Anchors after the characters behind the first ``head`` are replaced by ``tail``.

    ``found`` are the text's own, ``of_tail`` those of a text that starts with the tail. K-mers
    inside the head or the tail keep theirs, so only those across the border and the cut-off ones
    at the end are looked at.
    """
    first = F.greatest(F.lit(0), head - (K - 1)).cast("int")
    border = F.concat(F.substring(text, first + 1, head - first),
                      F.substring(tail, F.lit(1), F.lit(K - 1)))

    def joined(at: Column) -> Column:
        start, middle, size = at["start"], at["head"], at["size"]
        last = size - (K - 1)
        across = anchors(characters(border), start)
        moved = F.transform(F.filter(of_tail, lambda a: a < at["inside"]),
                            lambda a: a + at["to_head"])
        end = anchors(characters(F.substring(tail, last + 1, F.lit(K - 1))), middle + last)
        return F.concat(
            F.filter(found, lambda a: a < at["to_start"]),
            F.when(size < K, across).otherwise(F.concat(
                F.filter(across, lambda a: a < at["to_head"]), moved, end)))

    # Bound, as the lambdas would count the tail's characters for each anchor.
    size = F.char_length(tail)
    return let(F.struct(
        first.alias("start"), head.alias("head"), size.alias("size"), _at(first).alias("to_start"),
        _at(head).alias("to_head"), _at(size - (K - 1)).alias("inside")), joined)


def _block_of(key: Column, bounds: list[int]) -> Column:
    """How many of the descending bounds are above the key, in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    table = F.array(*[F.array(*map(F.lit, part)) for part in parts])
    firsts = F.array(*[F.lit(part[0]) for part in parts])
    coarse = F.size(F.filter(firsts, lambda b: b > key))
    fine = F.when(coarse > 0, F.size(F.filter(F.get(table, coarse - 1), lambda b: b > key)))
    return F.when(coarse > 0, (coarse - 1) * step + fine).otherwise(0).cast("int")


def _blocks(rows: DataFrame) -> int:
    """As many blocks as there are shuffle partitions, fewer where they would be small: each is a task
    that writes a file. Two for each core at least."""
    spark = rows.sparkSession
    most = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    least = 2 * spark.sparkContext.defaultParallelism
    if most <= least:
        return most
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(most, max(least, -(-size // BLOCK_BYTES)))


def _with_next(docs: DataFrame) -> DataFrame:
    """Documents with ``next_text`` and ``next_anchors`` of the next one.

    Documents are dealt to blocks of neighbouring ids, in one shuffle of the texts. Each block also
    gets the first row of the block behind it.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)))
    blocks = _blocks(rows)
    # One bound and one first id per block reach the driver.
    cuts = [i / blocks for i in range(blocks - 1, 0, -1)]
    found = rows.select(F.percentile_approx("key", cuts, 10 * blocks)).first()[0] if cuts else []
    bounds = sorted({int(b) for b in found or []}, reverse=True)
    rows = rows.withColumn("block", _block_of(F.col("key"), bounds))
    firsts = sorted((r["block"], r["first"]) for r in rows.groupBy("block").agg(
        F.max("key").alias("first")).collect())
    if not firsts:
        return None
    before = {first: firsts[at - 1][0] for at, (_, first) in enumerate(firsts)}
    to = F.create_map(*[x for first, block in before.items()
                        for x in (F.lit(first).cast("long"), F.lit(block))])
    guests = rows.where(F.col("key").isin(list(before))).withColumn("block", to[F.col("key")])
    dealt = (
        rows.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
        .repartitionByRange(blocks, "block")
        .withColumn("chars", characters(F.col("text")))
        .withColumn("anchors", anchors(F.col("chars")))
        .withColumn("n_chars", F.size("chars").cast("long")).drop("chars")
    )
    order = Window.partitionBy("block").orderBy("guest", F.desc("key"), F.sha2("text", 256))
    return dealt.withColumns({
        "next_text": F.lead("text").over(order),
        "next_anchors": F.lead("anchors").over(order),
    }).where("guest = 0")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last third replaced by the first characters of the next document. The
    next one has the next lower id; of rows with one id, the next by the digest of the text; null ids
    are the lowest; behind the last comes the first, which may be the document itself. Null texts are
    empty ones, whose fingerprint is empty. Other columns play no part; no documents give no rows.
    """
    rows = _with_next(docs)
    if rows is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                "edited_fingerprint string, near_edited double, near_next double")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    head = (F.col("n_chars") - cut).cast("int")
    edits = rows.withColumn("tail", F.substring(F.col("next_text"), F.lit(1), cut)).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), head), "tail"))
    changed = edited_anchors(F.col("anchors"), F.col("next_anchors"), F.col("text"), head,
                             F.col("tail"))
    hashes = {c: hashes_of(F.col(c)) for c in ("anchors", "changed", "next_anchors")}
    near = let(hashes["anchors"], lambda mine: F.struct(*[
        let(hashes[c], lambda other: likeness(mine, other)).alias(name)
        for c, name in (("changed", "edited"), ("next_anchors", "next"))]))
    return edits.withColumn("changed", changed).withColumn("near", near).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        F.col("near.edited").alias("near_edited"), F.col("near.next").alias("near_next"))
