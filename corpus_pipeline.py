"""A corpus pipeline over ``documents``: stages of operators, each written and read again.

Every stage works on all rows that the one before it kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import cotraining
from almanac.llm.byte_bpe import encode_documents
from almanac.llm.minhash import keep_one
from almanac.llm.mixing import mixed_rows
from almanac.llm.pii_surrogates import replace_pii
from almanac.llm.queries import NEAR_DUPLICATES, PII_KEY
from almanac.workload.scratch import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return cotraining.keep_good(docs, cotraining.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return keep_one(docs, NEAR_DUPLICATES)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates; ``n_chars`` is the new text's length."""
    return replace_pii(docs, PII_KEY, length="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, kept or repeated as the sources' targets want."""
    return mixed_rows(docs).withColumn("n_chars", F.when(
        F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and the digest of the bytes that they decode to."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("mix", mix),
          ("encode", encode)]
#: SQL expresses neither the classifier nor the near duplicates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
