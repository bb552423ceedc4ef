"""The registered queries: thin uses of the operators over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import cotraining, toxicity
from almanac.llm.base import let
from almanac.llm.byte_bpe import encode_documents
from almanac.llm.divergence import audit_sources
from almanac.llm.minhash import NearDuplicates, near_duplicate_classes
from almanac.llm.mixing import WORD, mix_documents
from almanac.llm.mtree import top_k
from almanac.llm.pii_surrogates import replace_pii
from almanac.llm.syncmers import fingerprint_documents
from almanac.llm.token_cache import token_counts
from almanac.llm.token_files import read_token_files, write_token_files
from almanac.llm.url_reputation import judge_pages
from almanac.llm.word_runs import word_runs
from almanac.workload.scratch import scratch_dir

PII_KEY = b"surrogates-1"
NEAR_DUPLICATES = NearDuplicates(weighted=True)
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/"))


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pii_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return replace_pii(docs, PII_KEY, count="n_replaced")


def token_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(_table(spark, sf, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))


def toxicity_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = toxicity.train(docs, _table(spark, sf, "labels").select("doc_id", "toxic"))
    return toxicity.score_documents(docs, model)


def near_duplicates_query(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicate_classes(_table(spark, sf, "documents"), NEAR_DUPLICATES)


def url_reputation_query(spark: SparkSession, sf: str) -> DataFrame:
    """The quality label whose id is the page's stands for the page's outcome."""
    labels = _table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judge_pages(_table(spark, sf, "pages"), labels, URL_RULES)


def fingerprints_query(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf, "documents"))


def byte_bpe_query(spark: SparkSession, sf: str) -> DataFrame:
    return encode_documents(
        _table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, with_ids=False)


def mixing_query(spark: SparkSession, sf: str) -> DataFrame:
    return mix_documents(_table(spark, sf, "documents"))


def top_k_query(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def quality_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = cotraining.train(docs, _table(spark, sf, "labels").select("doc_id", "quality"))
    return cotraining.score_documents(docs, model)


def periodic_text() -> Column:
    """The text of one document in ten, by the id's digest, made periodic behind some word."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.floor(digest / 10)

    def edited(words: Column) -> Column:
        n = F.size(words).cast("long")
        first = seed % n
        period = F.floor((n - first) / (F.lit(3) + seed % 8)) + 1
        repeated = F.transform(
            F.sequence(first, n - 1),
            lambda i: F.get(words, (first + (i - first) % period).cast("int")))
        return F.array_join(
            F.concat(F.slice(words, F.lit(1), first.cast("int")), repeated), " ")

    chosen = (digest % 10 == 0) & (F.regexp_count("text", F.lit(WORD)) > 0)
    return F.when(chosen, let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), edited)
                  ).otherwise(F.col("text"))


def word_runs_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", periodic_text().alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("least"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return word_runs(docs).select(
        "doc_id", "runs", "collapsed", longest.alias("longest"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.least")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.least").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def divergence_query(spark: SparkSession, sf: str) -> DataFrame:
    return audit_sources(_table(spark, sf, "documents"))


def token_files_query(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    write_token_files(_table(spark, sf, "documents"),
                      public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    return read_token_files(spark, folder, with_ids=False)


QUERIES = {
    "op1_pii_surrogates": pii_query,
    "op2_token_counts": token_counts_query,
    "op3_toxicity": toxicity_query,
    "op4_near_duplicates": near_duplicates_query,
    "op5_url_reputation": url_reputation_query,
    "op6_fingerprints": fingerprints_query,
    "op7_byte_bpe": byte_bpe_query,
    "op8_top_k": top_k_query,
    "op9_source_mix": mixing_query,
    "op10_quality": quality_query,
    "op11_word_runs": word_runs_query,
    "op12_source_divergence": divergence_query,
    "op13_token_files": token_files_query,
}
