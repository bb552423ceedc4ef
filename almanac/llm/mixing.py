"""Mixing sources to target weights by capped water-filling.

A source's target is ``min(cap, level * weight)``, where the level is the one at which the targets
sum to the wanted number of words: what sources above their cap give back is shared by weight
among the others until none is above. The level is found without iterating: with sources ordered
by ``cap / weight``, each prefix that is taken as capped gives a level, and the highest one is
feasible.

Documents are then repeated whole ``floor(target / size)`` times, and the remaining words come
from documents in a seeded order until they are used up; the last one gives part of its words.
The running sum goes over 65,536 hash buckets of a source first and over single documents in
the one bucket where the words run out, so a source of any size is sampled by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.base import tasks_for, text_or_empty, unused, written

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 4


@dataclass(frozen=True)
class Mix:
    """Weights go to the sources in code point order, null last, repeating."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    max_epochs: int = 2
    seed: str = "mix-1"


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def place(mix: Mix, doc_id: str = "doc_id") -> Column:
    """The document's place in the seeded order: 32 hexadecimal digits."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), key))


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, source_size, target`` of ``(source, source_size)``, one row per source.

    There are as many rows as sources, a small table. Sources without words get 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in mix.weights])
    ranked = sizes.withColumn(
        "weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(mix.weights)))
    capped = ranked.withColumn("cap", F.col("source_size") * F.lit(mix.max_epochs))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    wanted = F.sum("source_size").over(all_rows) * F.lit(float(mix.share))
    level = (wanted - filled.cast("double")) / open_weight.cast("double")
    return (
        capped.withColumn("level", level)
        .withColumn("level", F.max("level").over(all_rows))
        .select("source", "source_size",
                F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
                .alias("target"))
    )


def _plans(sized: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """Per source: targets, whole repetitions, further words and the bucket where they run out;
    and the documents' part of that bucket, by ``source, place, doc_id, size``."""
    bucket = F.substring("place", 1, BUCKET_DIGITS)
    sums = written(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")),
                   "mix-buckets")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = (
        source_targets(sizes, mix)
        .withColumn("whole", whole)
        .withColumn("further", F.floor(F.col("target") - F.col("whole") * F.col("source_size"))
                    .cast("long"))
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, 0)
    ends = (
        sums.withColumn("upto", F.sum("words").over(running))
        .join(targets.select(F.col("source").alias("s"), "further"),
              F.col("source").eqNullSafe(F.col("s")))
        .where("upto > further")
        .groupBy("source")
        .agg(F.min("bucket").alias("last_bucket"),
             F.min_by(F.col("upto") - F.col("words"), "bucket").alias("before"))
        .withColumnRenamed("source", "s")
    )
    plans = written(
        targets.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plans")
    part = plans.where("last_bucket is not null").select(
        F.col("source").alias("s"), "last_bucket", "before", "further")
    in_order = Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    last = (
        sized.join(part, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("last_bucket")))
        .groupBy("source", "place", "doc_id", "size", "before", "further")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("words", F.col("copies") * F.col("size"))
        .withColumn("upto", F.sum("words").over(in_order) + F.col("before"))
        .withColumn("left", F.greatest(F.lit(0), F.least(
            F.col("words"), F.col("further") - (F.col("upto") - F.col("words")))))
        .select("source", "place", "doc_id", "size",
                F.floor(F.col("left") / F.col("copies")).cast("long").alias("part"))
    )
    return plans, written(last, "mix-last")


def mix_documents(docs: DataFrame, mix: Mix = Mix(), keep_text: bool = False) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document, in rows of ``docs``.

    With ``keep_text`` there is also ``row``, a struct of the input's columns. A null text has no
    words; null sources are one source, the last; a null ``doc_id`` is a document as any other.
    Rows with the same ``doc_id`` and size share their further words evenly. Other columns play
    no part. No documents give no rows.
    """
    sized = docs.select("doc_id", "source", word_count().alias("size"), place(mix).alias("place"))
    sized = written(sized, "mix-sizes")
    with tasks_for(sized):
        plans, last = _plans(sized, mix)
    if keep_text:
        rows = docs.select(F.struct("*").alias("row"), "doc_id", "source",
                           word_count().alias("size"), place(mix).alias("place"))
    else:
        rows = sized
    bucket = F.substring("place", 1, BUCKET_DIGITS)
    plans = plans.withColumnRenamed("source", "s")
    last = last.select(F.col("source").alias("ls"), F.col("place").alias("lp"),
                       F.col("doc_id").alias("ld"), F.col("size").alias("lz"), "part")
    extra = (
        F.when(F.col("last_bucket").isNull() | (bucket < F.col("last_bucket")),
               F.when(F.col("further") > 0, F.col("size")).otherwise(0))
        .when(bucket == F.col("last_bucket"), F.coalesce("part", F.lit(0)))
        .otherwise(0)
    )
    same = (F.col("source").eqNullSafe(F.col("ls")) & (F.col("place") == F.col("lp"))
            & F.col("doc_id").eqNullSafe(F.col("ld")) & (F.col("size") == F.col("lz")))
    return (
        rows.join(plans, F.col("source").eqNullSafe(F.col("s")))
        .join(last, same, "left")
        .select(*["row"] * keep_text, "doc_id", "size", "source_size", "target",
                (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"))
    )


def mixed_rows(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: each document's row once for each whole repetition, and once more with the
    first words of its text where only a part is taken. Columns as in ``docs``."""
    rows = mix_documents(docs, mix, keep_text=True)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    # A part is a word with the white space behind it; white space in front is one of its own.
    parts = F.split(F.col("row.text"), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    indent = F.col("row.text").rlike(r"^[\x20\x09-\x0D]").cast("int")
    cut = F.array_join(F.slice(parts, F.lit(1), rest.cast("int") + indent), "")
    copy, text = unused(docs, "copy"), unused(docs, "cut_text")
    copies = F.concat(F.array_repeat(F.lit(False), times.cast("int")),
                      F.array_repeat(F.lit(True), (rest > 0).cast("int")))
    out = rows.withColumn(copy, F.explode(copies)).withColumn(
        text, F.when(F.col(copy), cut)
        .otherwise(F.col("row.text")))
    return out.select(*[F.col(text).alias(c) if c == "text" else F.col("row")[c].alias(c)
                        for c in docs.columns])
