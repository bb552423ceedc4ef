import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almanac.llm import divergence as V

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_dictionaries(docs, least=3, top=200):
    """Plain integers over dictionaries; every kept term of every pair."""
    groups, langs, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(SMALL))
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t in langs[lang] if seen[lang][t] >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        mine, whole = shares(groups[lang, source]), shares(langs[lang])
        pairs = []
        for other in [s for x, s in groups if x == lang and s != source]:
            q = shares(groups[lang, other])
            pairs.append((other, sum((mine[t] - q[t]) ** 2 // q[t] for t in kept)))
        terms = [(t, (mine[t] - whole[t]) ** 2 // whole[t]) for t in kept
                 if groups[lang, source][t] and mine[t] > whole[t]]
        for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
            values.sort(key=lambda v: (-v[1], v[0].encode()))
            out += [(lang, source, part, item, value, rank)
                    for rank, (item, value) in enumerate(values[:limit], 1)]
    return sorted(out)


def audited(docs, **audit):
    return sorted(tuple(r) for r in V.audit_sources(docs, V.Audit(**audit)).collect())


def frame(spark, docs):
    return spark.createDataFrame(docs, "lang string, source string, text string")


def sample(seed, sources, n):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "délta", "Épsilon", "ζήτα", "漢字", "x9y", "it's", "a_b"]
    docs = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(sources)
        favourite = words[len((lang or "") + (source or "")) % 5:]
        docs.append((lang, source, rng.choice([" ", "\n", "\x00", "_"]).join(
            rng.choice(favourite) + rng.choice(["", "", str(rng.randint(0, 30)), "q"])
            for _ in range(rng.choice([0, 1, 5, 40])))))
    return docs + [("en", "lone", None), ("fr", "only", "un deux trois"), ("ja", "a", ""),
                   ("ja", "b", "x"), ("en", "src", "word " * 3000)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 4000)), st.sets(st.integers(0, 4000), max_size=40),
       st.integers(1, 9))
def test_gallop_finds_the_common_ids(one, two, spread):
    one = np.array(sorted({x * spread for x in one} | set(range(0, 3000 * (spread > 5)))), np.int32)
    two = np.array(sorted(two), np.int32)
    for short, long in ((one, two), (two, one)):
        mine, theirs = V.gallop(short, long)
        assert short[mine].tolist() == sorted(set(one.tolist()) & set(two.tolist()))
        assert (short[mine] == long[theirs]).all()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**12), st.integers(1, 10**13))
def test_shares_are_exact(count, more):
    total = count + more
    expected = 1 + 10**9 * (count + 1) // total
    assert V.shares(np.array([count]), total).tolist() == [expected]


def test_shares_of_a_column_are_exact(spark):
    rows = [(0, 1), (5, 7), (10**12, 3 * 10**12 + 1), (10**15, 9 * 10**15 - 1)]
    got = spark.createDataFrame(rows, "c long, t long").select(
        "c", "t", V.share(F.col("c"), F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(c, t, 1 + 10**9 * (c + 1) // t) for c, t in rows]


def test_audit_by_dictionaries(spark):
    docs = sample(3, ["src", "web", "", None, "Z", "é"], 150)
    assert audited(frame(spark, docs)) == by_dictionaries(docs)
    assert audited(frame(spark, docs), least=1, top=3) == by_dictionaries(docs, 1, 3)


def test_many_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "TILE", 2)
    monkeypatch.setattr(V, "BLOCK_ROWS", 40)
    docs = sample(4, [f"s{k}" for k in range(7)], 120)
    assert audited(frame(spark, docs)) == by_dictionaries(docs)


def test_tasks_that_send_their_counts_early(monkeypatch):
    monkeypatch.setattr(V, "TERMS_HELD", 3)
    docs = [("en", "a", b"One two two"), ("en", "b", b"two"), ("en", "a", b"one FOUR five"),
            ("en", "a", b"")]
    batches = [pa.RecordBatch.from_pylist(
        [dict(zip(("lang", "source", "text"), d))]) for d in docs]
    n, seen = Counter(), Counter()
    for batch in V._count_terms(iter(batches)):
        for row in batch.to_pylist():
            n[row["source"], row["term"]] += row["n"]
            seen[row["source"], row["term"]] += row["docs"]
    assert n == {("a", None): 0, ("b", None): 0, ("a", "one"): 2, ("a", "two"): 2, ("b", "two"): 1,
                 ("a", "four"): 1, ("a", "five"): 1}
    assert seen["a", "one"] == 2 and seen["a", "two"] == 1


def test_documents_of_every_kind(spark, messy, no_documents):
    rows = [(r["lang"], r["source"], r["text"]) for r in messy.collect()]
    assert audited(messy) == by_dictionaries(rows)
    assert audited(messy, least=1) == by_dictionaries(rows, 1)
    assert audited(no_documents) == []
    assert V.audit_sources(no_documents).columns == [
        "lang", "source", "part", "item", "value", "rank"]
