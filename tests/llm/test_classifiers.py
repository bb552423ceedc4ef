import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import cotraining, toxicity
from almanac.llm.gru import BiGru
from almanac.llm.toxicity import Toxicity, ToxicModel, fit, window_starts, words_of

from .conftest import prose, texts

FAST = Toxicity(char_steps=150, word_steps=160, passes=2)


def corpus(n, seed):
    """A fifth are toxic: a few words with a common stem among prose."""
    rng = random.Random(seed)
    out, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randrange(5, 150)).split()
        toxic = i % 5 == 0
        for _ in range(rng.randrange(1, 4) * toxic):
            ending = "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 4)))
            words.insert(rng.randrange(len(words) + 1), f"gromp{ending}")
        out.append(" ".join(words))
        labels.append(int(toxic))
    return out, np.array(labels)


@pytest.fixture(scope="module")
def toxic_model():
    sample, labels = corpus(900, 1)
    calibrating = np.array([zlib.crc32(t.encode()) % 5 == 0 for t in sample])
    return fit(sample, labels, calibrating, np.ones(len(sample)), FAST)


def test_gradients():
    rng = np.random.default_rng(0)
    layer = BiGru(3, 4, rng)
    layer.params = {k: v.astype(float) for k, v in layer.params.items()}
    x, mask = rng.standard_normal((5, 3, 6)), (rng.random((5, 6)) < 0.8).astype(float)
    slope = rng.standard_normal((8, 6))

    def value():
        gates = layer.project(x)
        return float((layer.forward(lambda side, t: gates[side][t], mask) * slope).sum())

    keep, gates = {}, layer.project(x)
    layer.forward(lambda side, t: gates[side][t], mask, keep)
    grads, by_x = layer.backward(x, keep, slope)
    for array, grad in [*((layer.params[k], grads[k]) for k in grads), (x, by_x)]:
        at = tuple(rng.integers(0, d) for d in array.shape)
        old = array[at]
        up, down = (array.__setitem__(at, old + e) or value() for e in (1e-3, -1e-3))
        array[at] = old
        assert (up - down) / 2e-3 == pytest.approx(grad[at], rel=2e-2, abs=1e-3)


def test_toxicity_on_held_out_documents(toxic_model):
    sample, labels = corpus(600, 2)  # other words with the stem, other endings
    predicted = toxic_model.score(sample) >= 0.5
    assert (predicted == labels).mean() >= 0.95
    assert predicted[labels == 1].mean() >= 0.9 and predicted[labels == 0].mean() <= 0.03


def test_scores_equal_single_windows(toxic_model):
    sample, _ = corpus(12, 3)
    sample += ["", "   ", "gromper " + prose(8, 900), prose(8, 900) + " gromper"]
    by = toxic_model.by
    for text, score in zip(sample, toxic_model.score(sample)):
        words = words_of(text, by.word_chars)
        logits = []
        for start in window_starts(len(words), by):
            part = words[start:start + by.window]
            vectors = toxic_model.word_vectors(part) if part else np.zeros(
                (2 * by.char_hidden + 2, 1), np.float32)
            gates = toxic_model.words.project(vectors)
            mask = np.ones((max(1, len(part)), 1), np.float32) * bool(part)
            pooled = toxic_model.words.forward(lambda side, t: gates[side][:, t:t + 1], mask)
            logits.append(float((toxic_model.head["w"] @ pooled + toxic_model.head["c"])[0]))
        a, b, c = toxic_model.calibration
        want = 1 / (1 + np.exp(-(a * max(logits) + b * np.log(len(logits)) + c)))
        assert score == pytest.approx(want, abs=1e-3)


def test_windows_cover_and_overlap():
    by = Toxicity()
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        covered = set()
        for start in window_starts(n, by):
            covered |= set(range(start, min(n, start + by.window)))
        assert covered == set(range(n))


def test_words_keep_the_whole_text():
    long = "y" * 5001
    assert "".join(words_of(f"a {long} B", 20)) == f"a{long}b"


def test_memo_is_bounded(toxic_model):
    sample, _ = corpus(40, 4)
    before = toxic_model.score(sample)
    small = ToxicModel.__new__(ToxicModel)
    small.__dict__ = toxic_model.__getstate__() | {"by": Toxicity(cached_words=50)}
    parts = np.concatenate([small.score(sample[i:i + 1]) for i in range(len(sample))])
    assert np.allclose(parts, before, atol=1e-4)


def test_toxicity_of_messy_documents(spark, messy, toxic_model):
    rows = toxicity.score_documents(messy, toxic_model).collect()
    assert len(rows) == messy.count()
    for row in rows:
        held = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
        assert row["held_out"] == held and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)


def test_toxicity_never_learns_held_out_labels(spark):
    sample, labels = corpus(400, 5)
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(400)])
    docs = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")

    def scores(marks):
        known = spark.createDataFrame([(i, int(m)) for i, m in enumerate(marks)] + [(None, 1), (3, None)],
                                      "doc_id long, toxic int")
        model = toxicity.train(docs, known, FAST)
        return [r["score"] for r in toxicity.score_documents(docs, model).orderBy("doc_id").collect()]

    assert scores(labels) == pytest.approx(scores(np.where(held, 1 - labels, labels)), abs=1e-6)


def test_toxicity_without_both_classes(spark, messy, no_documents):
    for rows, want in (([], 0), ([(1, 0)], 0), ([(1, 1), (2, 1)], 1)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = toxicity.train(messy, labels)
        assert {r["predicted"] for r in toxicity.score_documents(messy, model).collect()} == {want}
        assert toxicity.score_documents(no_documents, model).count() == 0


def test_a_long_text_takes_no_other_place_in_the_sample(spark):
    sample, labels = corpus(400, 6)
    ids = spark.range(400).selectExpr("id", "xxhash64(id) AS place", "crc32(CAST(id AS STRING)) % 5 AS held")
    first = ids.where("held <> 0").orderBy("place").first()["id"]
    sample[first] = prose(7, 40_000)
    labels[first] = 0
    docs = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    known = spark.createDataFrame([(i, int(m)) for i, m in enumerate(labels)], "doc_id long, toxic int")
    by = Toxicity(char_steps=150, word_steps=160, passes=2, sample_bytes=200_000)
    assert len(sample[first]) > by.sample_bytes
    model = toxicity.train(docs, known, by)
    assert isinstance(model, ToxicModel)
    predicted = model.score(sample) >= 0.5
    assert predicted[labels == 1].mean() >= 0.9 and predicted[labels == 0].mean() <= 0.05


def test_sample_has_both_classes():
    by = Toxicity()

    def rows(label, sizes):
        return pa.table({"label": pa.array([label] * len(sizes), pa.int32()),
                         "bytes": pa.array(sizes, pa.int32())})

    def kept(clean, toxic):
        out = toxicity._chosen([rows(0, clean), rows(1, toxic)], by).to_pylist()
        assert sum(r["bytes"] if r["whole"] else by.sample_bytes // 100 for r in out) <= by.sample_bytes
        return [[(r["bytes"], r["whole"]) for r in out if r["label"] == c] for c in (0, 1)]

    assert kept([2000] * 3000, [2000] * 1500) == [[(2000, True)] * 3000, [(2000, True)] * 1500]
    assert kept([5000] * 3000, [100] * 10)[1] == [(100, True)] * 10
    assert list(map(len, kept([20 << 20] * 80, [5 << 20] * 70))) == [50, 50]
    assert kept([2000] * 3000, [2000] * 60 + [1 << 30]) == [[(2000, True)] * 3000, [(2000, True)] * 60]


def test_excerpts_are_bounded_and_of_whole_words():
    text = prose(11, 20_000)
    part = toxicity.excerpt(text, 10_000)
    assert 8_000 < len(part) <= 10_500 and set(part.split()) <= set(text.split())
    assert toxicity.excerpt(text, len(text)) == text and toxicity.excerpt("", 10) == ""
    assert len(toxicity.excerpt("é" * 100_000, 10_000)) <= 5_100


def test_toxicity_learns_from_one_row_for_each_id(spark, monkeypatch):
    rows = [(i, f"text {i}") for i in range(40)] * 2 + [(7, f"other {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda *args: seen.append(args))
    toxicity.train(docs, labels)
    held = sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(40))
    assert len(seen[0][0]) == len(set(seen[0][0])) == 40 - held


def test_quality_learns_from_one_row_for_each_id(spark, monkeypatch):
    rows = [(i, f"text {i}") for i in range(40)] * 2 + [(i, f"other {k}") for i in (7, 33)
                                                        for k in range(300)]
    rows += [(None, f"nobody {k}") for k in range(1000)] + [(None, "same")] * 500
    docs = spark.createDataFrame([(*r, "en", "src", 5) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(cotraining, "co_train", lambda *args: seen.append(args))
    cotraining.train(docs.repartition(4), labels)
    assert len(seen[0][2]) == 20


def test_every_other_document_is_exchanged(spark, monkeypatch):
    """Whatever their number, with and without an id; documents with the same bins count once."""
    rows = documents(300, 3)
    docs = spark.createDataFrame(
        [(r[0] if r[0] % 5 else None, *r[1:5]) for r in rows] * 2 + [rows[299][:5]] * 400,
        "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows[:100]], "doc_id long, quality int")
    seen = []

    def counted(self, views):
        seen.append([bytes(r["bins"]) for r in self.table.collect()])
        return np.zeros((2, cotraining.CELLS), np.int64)

    monkeypatch.setattr(cotraining.Pool, "counts", counted)
    model = cotraining.train(docs, labels)
    sampled = {r[0] for r in rows[:100] if r[0] % 5}
    others = [r for r in rows if r[0] not in sampled]
    x = [np.array([f(*r) for r in others], np.float32) for f in (
        lambda _, text, *rest: cotraining.text_features(text),
        lambda _, text, lang, source, n, good: cotraining.metadata_features(text, lang, source, n))]
    want = {row.tobytes() for row in np.hstack([v.bins(b) for v, b in zip((model.text, model.meta), x)])}
    assert set(seen[0]) == want and len(seen[0]) == len(want)


def local_pool(spark, bins, parts=3):
    rows = [(bytearray(row.tobytes()),) for row in np.hstack(bins)]
    return cotraining.Pool(spark.createDataFrame(rows, "bins binary").repartition(parts))


def two_views(n, seed=0):
    rng = np.random.default_rng(seed)
    label = np.where(rng.random(n) < 0.3, 0.0, 1.0)
    return label, [(label + noise * rng.standard_normal(n))[:, None] for noise in (0.1, 0.4)]


def test_sums_over_tasks_equal_sums_over_all(spark):
    by = cotraining.CoTraining(exchanged=0.2, confidence=0.6)
    label, data = two_views(9000)
    views = [cotraining.View(x, by) for x in data]
    bins = [v.bins(x) for v, x in zip(views, data)]
    for v, b in zip(views, bins):
        v.beta = cotraining._logistic(v.one_hot(b[:50]), label[:50], by.ridge)
    pool = local_pool(spark, bins)
    counts = pool.counts(views)
    assert (counts == cotraining.count_cells(views, bins)).all() and (counts.sum(axis=1) == 9000).all()
    givers = [[cotraining.Giver(v, c, 0.7, by)] for v, c in zip(views, counts)]
    sums = pool.added_up(views, givers)
    for got, want in zip(sums, cotraining.add_up(views, givers, bins)):
        assert np.allclose(got, want) and got[0, -1] > 0
    marks = givers[0][0].marks(bins[0])
    cells = views[0].cells(bins[0])
    for value, share in ((1, 0.7), (0, 0.3)):
        given = marks == value
        least = cells[given].min() if value else -cells[given].max()
        inside = given & (cells != (least if value else -least))
        assert given.sum() >= 0.2 * share * 9000 > inside.sum()  # whole cells, and no more of them


def test_steps_over_tasks_end_where_weighted_rows_do(spark):
    """Newton's steps with the pool's sums find the optimum of labelled and pseudo-labelled rows."""
    by = cotraining.CoTraining(rounds=1, exchanged=0.2, confidence=0.6, steps=30)
    label, data = two_views(3000, 1)
    views, held, pools = [], np.arange(100) % 4 == 0, []

    def pool_of(made):
        views.extend(made)
        pools.append([v.bins(x[100:]) for v, x in zip(made, data)])
        return local_pool(spark, pools[0])

    first = [cotraining.View(x[:100], by) for x in data]
    model = cotraining.co_train(data[0][:100], data[1][:100], label[:100], held, pool_of, by)
    y = label[:100][~held]
    for v, x in zip(first, data):
        v.beta = cotraining._logistic(v.one_hot(v.bins(x[:100][~held])), y, by.ridge)
        v.calibrate(v.bins(x[:100][~held]), y)
    counts = cotraining.count_cells(first, pools[0])
    givers = [cotraining.Giver(v, c, y.mean(), by) for v, c in zip(first, counts)]
    for at, view in enumerate((model.text, model.meta)):
        marks = givers[1 - at].marks(pools[0][1 - at])
        known = ~np.isnan(marks)
        weight = min(0.5, len(y) / known.sum())
        assert known.sum() > 2 * len(y)
        x = np.vstack([view.one_hot(view.bins(data[at][:100][~held])), view.one_hot(pools[0][at][known])])
        p = 1 / (1 + np.exp(-x @ view.beta))
        weights = np.r_[np.ones(len(y)), np.full(known.sum(), weight)]
        penalty = np.r_[np.full(x.shape[1] - 1, by.ridge), 1e-3]
        slope = x.T @ (weights * (p - np.r_[y, marks[known]])) + penalty * view.beta
        assert np.abs(slope).max() < 0.05


def documents(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text, good = prose(seed * 10_000 + i, rng.randrange(20, 200)), i % 6 != 0
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "&&& "),
                               " ".join(w for w in text.split() for _ in range(8))])
        rows.append((i, text, rng.choice(["en", "de", None]), f"src{rng.randrange(4)}", len(text),
                     int(good)))
    return rows


@pytest.fixture(scope="module")
def quality(spark):
    rows = documents(600, 1)
    docs = spark.createDataFrame([r[:5] for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % 5 < 2], "doc_id long, quality int")
    return docs, labels, cotraining.train(docs, labels)


def test_quality_on_unlabelled_documents(spark, quality):
    docs, _, model = quality
    want = {r[0]: bool(r[5]) for r in documents(600, 1)}
    rows = cotraining.score_documents(docs, model).collect()
    assert len(rows) == 600
    wrong = [r for r in rows if r["keep"] != want[r["doc_id"]]]
    assert len(wrong) <= 6 and all(0 <= r["score"] <= 1 for r in rows)
    kept = {r["doc_id"] for r in cotraining.keep_good(docs, model).collect()}
    assert kept == {r["doc_id"] for r in rows if r["keep"]}


class InOneTask:
    """A pool whose sums are those of one block."""

    def __init__(self, bins):
        self.bins = bins

    def counts(self, views):
        return cotraining.count_cells(views, self.bins)

    def added_up(self, views, givers):
        return cotraining.add_up(views, givers, self.bins)


def test_each_view_learns_from_the_other():
    """Text tells the classes apart; metadata does so only with the other view's pseudo-labels."""
    known, held = np.arange(2000) < 100, np.arange(100) % 4 == 0

    def errors(rounds, seed):
        label, data = two_views(2000, seed)
        model = cotraining.co_train(
            data[0][known], data[1][known], label[known], held,
            lambda views: InOneTask([v.bins(x[~known]) for v, x in zip(views, data)]),
            cotraining.CoTraining(rounds=rounds, exchanged=0.2))
        return np.array([((model.meta.logit(model.meta.bins(data[1])) > 0) != (label > 0)).mean(),
                         ((model.score(*data) >= 0.5) != (label > 0)).mean()])

    few, many = (sum(errors(rounds, seed) for seed in range(8)) for rounds in (0, 6))
    assert (many < few).all()


def test_quality_of_messy_documents(spark, messy, no_documents, quality):
    model = quality[2]
    assert cotraining.score_documents(messy, model).count() == messy.count()
    kept = cotraining.keep_good(messy, model)
    assert kept.columns == messy.columns and kept.count() <= messy.count()
    assert cotraining.score_documents(no_documents, model).count() == 0
    assert cotraining.keep_good(no_documents, model).count() == 0


def test_messy_documents_are_exchanged(spark, messy):
    rows = documents(200, 5)
    docs = spark.createDataFrame([(r[0] + 1000, *r[1:5]) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    both = messy.unionByName(docs, allowMissingColumns=True)
    labels = spark.createDataFrame(
        [(r[0] + 1000, r[5]) for r in rows[:120]] + [(1, 1), (None, 0), (4, None)],
        "doc_id long, quality int")
    model = cotraining.train(both, labels)
    assert isinstance(model, cotraining.QualityModel)
    assert cotraining.score_documents(both, model).where("score between 0 and 1").count() == both.count()
    only = cotraining.train(docs, labels.union(spark.createDataFrame(
        [(r[0] + 1000, r[5]) for r in rows[120:]], labels.schema)))  # no other documents
    assert isinstance(only, cotraining.QualityModel)


@pytest.mark.parametrize("rows, keep", [([], True), ([(1, 1)], True), ([(1, 0), (2, 0)], False),
                                        ([(1, None), (None, 0)], True)])
def test_quality_without_both_classes(spark, messy, no_documents, rows, keep):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    model = cotraining.train(messy, labels)
    assert {r["keep"] for r in cotraining.score_documents(messy, model).collect()} == {keep}
    assert cotraining.train(no_documents, labels).score(np.zeros((1, 1)), None)[0] == 1.0


def test_texts_fixture(messy):
    assert len(texts(messy)) == messy.count()
