import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import SMOKE_DIR, queries
from almanac.llm import base, cotraining, minhash, mixing, pii_surrogates
from almanac.llm.mixing import mix_documents, mixed_rows
from almanac.llm.pii_surrogates import replace, replace_pii
from almanac.llm.queries import NEAR_DUPLICATES, PII_KEY, QUERIES

from .conftest import prose, texts
from .test_minhash import brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_queries_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= queries().keys()


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage is compared with what its input should become."""
    inputs, docs = [], spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(docs)
        out = stage(spark, docs, SMOKE_DIR)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == COLUMNS, name
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
    labels = spark.read.parquet(f"{SMOKE_DIR}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    kept = {d for d, _ in texts(inputs[1])}
    assert len(good - kept) <= 0.02 * len(good) and len(bad & kept) <= 0.1 * len(bad)
    unique = sorted(texts(inputs[2]))
    assert [d for d, _ in unique] == sorted({c for _, c in brute_force(sorted(texts(inputs[1])))})
    assert sorted(texts(inputs[3])) == [(d, replace(t, PII_KEY, {})[0]) for d, t in unique]
    taken = {r["doc_id"]: r["taken"] for r in mix_documents(inputs[3]).collect()}
    mixed = {}
    for doc_id, text in texts(inputs[4]):
        mixed[doc_id] = mixed.get(doc_id, 0) + len(text.split())
    assert mixed == {d: n for d, n in taken.items() if n}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    assert sorted((r["doc_id"], list(r["ids"])) for r in docs.collect()) == sorted(
        (d, library.encode_ordinary(t)) for d, t in texts(inputs[4]))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_messy_and_empty_documents(spark, messy, no_documents, name, stage):
    for docs in (messy, no_documents):
        out = stage(spark, docs, SMOKE_DIR)
        if name != "encode":
            assert out.columns == docs.columns
        assert (out.count() == 0) == (docs is no_documents)


def test_stages_write_small_intermediates_in_few_files(spark, monkeypatch):
    """Also with many shuffle partitions that Spark doesn't coalesce."""
    conf = {"spark.sql.shuffle.partitions": "90",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    most = 2 * spark.sparkContext.defaultParallelism
    files = {}

    def counted(df, name, **more):
        out = base.written(df, name, **more)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    for module in (minhash, pii_surrogates, mixing, cotraining):
        monkeypatch.setattr(module, "written", counted)
    rows = [(i, f"Mail u{i}@site{i}.net to {prose(i // 2 + 1, 60)}", "en", f"src{i}", i)
            for i in range(80)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                           "n_chars long")
        labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")).where("doc_id < 60")
        assert cotraining.keep_good(docs, cotraining.train(docs, labels)).count() <= 80
        kept = minhash.keep_one(docs, NEAR_DUPLICATES)
        assert kept.rdd.getNumPartitions() <= most
        assert 40 <= kept.count() <= 80
        assert replace_pii(docs, PII_KEY).where("text like '%@site%'").isEmpty()
        assert mixed_rows(docs).count() >= 80
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    inputs = {"mix-sizes", "minhash-signed"}
    assert {"quality-bins", "minhash-kept", "pii-mentions", "mix-buckets"} <= files.keys()
    assert {k: v for k, v in files.items() if max(v) > most and k not in inputs} == {}
    gathered = {k for k in files if k.startswith("minhash") and k not in inputs}
    assert max(n for k in gathered for n in files[k]) <= 2


def test_tables_are_gathered_by_their_size(spark):
    least = 2 * spark.sparkContext.defaultParallelism
    rows = spark.range(100).repartition(50)

    def files(size):
        with base.tasks_for(rows, F.lit(size)) as tasks:
            return len(base.written(rows, "sized").inputFiles()), tasks

    assert files(8) == (2, least)
    assert files(3 * base.BYTES_IN_FILE // 100)[0] == 3
    assert files(least * base.BYTES_IN_FILE // 100)[0] == least
    assert files(least * base.BYTES_IN_TASK)[1] == 100 * least
    with base.tasks_for(spark.range(0), F.col("id")):
        assert base.written(spark.range(0).toDF("id"), "none").count() == 0
    assert base.written(rows, "after").inputFiles() and base._FILES.get() is None
