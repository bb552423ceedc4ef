"""Quality classifier by co-training on two views of a document.

The text view sees what the words and characters are; the metadata view sees the record: language,
source, stated length, line layout and how far the text compresses. Each view has its own
classifier (logistic regression over binned features). In each round either one labels the
unlabelled documents that it is most sure of, for the other one to learn from. At the end
each view is calibrated on labelled rows that neither has learned from, and the calibrated views
are combined.

Labelled rows are a sample of bounded size on the driver. All other documents take part in the
exchange, where they are: a written table holds the bins of each distinct one (a byte for a
feature), tasks count how sure the views are and add up the slopes and curvatures of Newton's
method, and what a document has been labelled follows from the views of the rounds before. Only
counts and sums, whose size is that of the model, reach the driver. All documents are scored.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.base import intermediates, tasks_for, text_digest, unused, written
from almanac.session import ship_package

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ROWS_AT_ONCE = 256
BINNED_AT_ONCE = 4096
CELLS = 4096
REACH = 16.0
_SYMBOLS = re.compile(r"[^\w\s.,;:'’\"()?-]+")
_DIGIT = re.compile(r"\d")


@dataclass(frozen=True)
class CoTraining:
    """``labelled`` bounds the sample of labelled rows, by a hash of ``doc_id``. ``exchanged`` is the
    share of the other documents that a view labels in a round. A pseudo-label weighs half a label,
    and less where all of a view's would weigh more than ``influence`` times its labels."""

    labelled: int = 20_000
    rounds: int = 4
    exchanged: float = 0.05
    confidence: float = 0.95
    influence: float = 1.0
    steps: int = 8
    bins: int = 8
    ridge: float = 1.0
    threshold: float = 0.5


def text_features(text: str) -> list[float]:
    """Words with digits are left out: numbers and addresses say nothing about the prose."""
    words = text.split()
    if _DIGIT.search(text):
        words = [word for word in words if not _DIGIT.search(word)]
        text = " ".join(words)
    n, chars = max(1, len(words)), max(1, len(text))
    return [
        np.log1p(len(words)),
        len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        len(text) / n,
        sum(map(len, _SYMBOLS.findall(text))) / chars,
        *[text.count(mark) / chars for mark in PUNCTUATION],
    ]


def metadata_features(text: str, lang: str | None, source: str | None,
                      n_chars: int | None) -> list[float]:
    """``lang`` and ``source`` are hashed into one-hot groups at the end."""
    lines = text.split("\n")
    raw = text.encode()
    sizes = [len(line) for line in lines]
    return [
        np.log1p(max(0, n_chars if n_chars is not None else len(text))),
        float(n_chars is not None and n_chars != len(text)),
        np.log1p(len(lines)), float(np.mean(sizes)), float(max(sizes)),
        len(set(lines)) / len(lines),
        len(zlib.compress(raw, 1)) / max(1, len(raw)),
        len(raw) / max(1, len(text)),
        float(lang is None) or 1.0 + zlib.crc32(lang.encode()) % 8,
        float(source is None) or 1.0 + zlib.crc32(source.encode()) % 16,
    ]


N_TEXT = len(text_features(""))


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    text = np.array([text_features(t) for t in texts], np.float32)
    meta = np.array([metadata_features(*row) for row in zip(
        texts, *(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")))], np.float32)
    return text, meta


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(beta: np.ndarray, slope: np.ndarray, curve: np.ndarray, ridge: float) -> np.ndarray:
    """A step of Newton's method with a penalty on all but the last coefficient, the intercept."""
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-3
    step = np.linalg.solve(curve + np.diag(penalty), slope + penalty * beta)
    return step / max(1.0, np.abs(step).max() / 2)  # far steps overshoot


def _slope_and_curve(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _sigmoid(x @ beta)
    return x.T @ (p - y), (x * (p * (1 - p) + 1e-6)[:, None]).T @ x


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        step = _step(beta, *_slope_and_curve(x, y, beta), ridge)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


class View:
    """A classifier over bins of each feature, at quantiles of the rows and of the values."""

    def __init__(self, sample: np.ndarray, by: CoTraining):
        cuts = np.linspace(0, 1, by.bins + 1)[1:-1]
        self.edges = [  # of the values too, as most documents have 0 of some
            np.unique(np.concatenate([np.quantile(x, cuts) for x in (column, np.unique(column))]))
            for column in sample.T]
        self.starts = np.cumsum([0, *(len(e) + 1 for e in self.edges)])
        self.ridge = by.ridge
        self.beta = np.zeros(self.starts[-1] + 1)
        self.scale, self.shift = 1.0, 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(edges, column, side="left")
                         for edges, column in zip(self.edges, x.T)], axis=1).astype(np.uint8)

    def one_hot(self, bins: np.ndarray) -> np.ndarray:
        """The last column is the intercept."""
        out = np.zeros((len(bins), len(self.beta)))
        out[np.arange(len(bins))[:, None], self.starts[:-1] + bins] = 1
        out[:, -1] = 1
        return out

    def logit(self, bins: np.ndarray) -> np.ndarray:
        return self.beta[self.starts[:-1] + bins].sum(axis=1) + self.beta[-1]

    def calibrate(self, bins: np.ndarray, y: np.ndarray) -> None:
        raw = np.stack([self.logit(bins), np.ones(len(bins))], axis=1)
        self.scale, self.shift = _logistic(raw, y, 0.5)

    def calibrated(self, bins: np.ndarray) -> np.ndarray:
        return self.scale * self.logit(bins) + self.shift

    def cells(self, bins: np.ndarray) -> np.ndarray:
        """The calibrated logits on a grid."""
        at = (self.calibrated(bins) + REACH) * (CELLS / (2 * REACH))
        return np.clip(at, 0, CELLS - 1).astype(np.int64)


class Giver:
    """A view of some round, and the cells from and up to which it is sure of a class."""

    def __init__(self, view: View, counts: np.ndarray, share: float, by: CoTraining):
        """``counts`` are of the unlabelled documents in each cell. The surest are taken in whole
        cells until there are enough."""
        self.view = copy.copy(view)
        sure = np.log(by.confidence / (1 - by.confidence))
        wanted = by.exchanged * counts.sum()
        above = np.cumsum(counts[::-1])[::-1] - counts
        below = np.cumsum(counts) - counts
        edge = (np.arange(CELLS) * (2 * REACH / CELLS)) - REACH
        self.high = np.flatnonzero(np.append((above < wanted * share) & (edge >= sure), True))[0]
        self.low = np.flatnonzero(np.append(
            True, (below < wanted * (1 - share)) & (edge + 2 * REACH / CELLS <= -sure)))[-1] - 1

    def marks(self, bins: np.ndarray) -> np.ndarray:
        cells = self.view.cells(bins)
        return np.where(cells >= self.high, 1.0, np.where(cells <= self.low, 0.0, np.nan))


def pseudo_labels(givers: list[Giver], bins: np.ndarray) -> np.ndarray:
    """The label of the first giver that was sure, else NaN."""
    out = np.full(len(bins), np.nan)
    for giver in givers:
        open_ = np.isnan(out)
        out[open_] = giver.marks(bins[open_])
    return out


def count_cells(views: list[View], both: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.bincount(v.cells(b), minlength=CELLS) for v, b in zip(views, both)])


def add_up(views: list[View], givers: list[list[Giver]], both: list[np.ndarray]) -> list[np.ndarray]:
    """For each view ``curve | slope | count`` over the documents that the other view has labelled."""
    out = []
    for at, view in enumerate(views):
        label = pseudo_labels(givers[1 - at], both[1 - at])
        known = ~np.isnan(label)
        slope, curve = _slope_and_curve(view.one_hot(both[at][known]), label[known], view.beta)
        out.append(np.column_stack([curve, slope, np.full(len(slope), float(known.sum()))]))
    return out


class Pool:
    """The unlabelled documents: a table whose ``bins`` are the bytes of the bins of both views."""

    def __init__(self, table: DataFrame):
        self.table = table

    def _sums(self, start: list[np.ndarray], part) -> list[np.ndarray]:
        """Sums of the arrays that ``part`` gives for blocks of documents: within a task, then
        row by row over the tasks."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [x.copy() for x in start]
            for batch in batches:
                for at in range(0, batch.num_rows, BINNED_AT_ONCE):
                    rows = batch.column("bins").slice(at, BINNED_AT_ONCE).to_pylist()
                    bins = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
                    for x, more in zip(total, part(bins)):
                        x += more
            for view, x in enumerate(total):
                if x.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([view] * len(x), pa.int32()), pa.array(range(len(x)), pa.int32()),
                         pa.array(list(x), pa.list_(pa.float64()))], ["view", "row", "x"])

        def add(group: pa.Table) -> pa.Table:
            x = np.array(group.column("x").to_pylist()).sum(axis=0)
            return pa.table([group.column("view").slice(0, 1), group.column("row").slice(0, 1),
                             pa.array([x], pa.list_(pa.float64()))], ["view", "row", "x"])

        kind = "view int, row int, x array<double>"
        sums = self.table.mapInArrow(run, kind).groupBy("view", "row").applyInArrow(add, kind)
        total = [x.copy() for x in start]
        for row in sums.toArrow().to_pylist():
            total[row["view"]][row["row"]] = row["x"]
        return total

    def counts(self, views: list[View]) -> np.ndarray:
        width = len(views[0].edges)
        return np.stack([x[0] for x in self._sums(
            [np.zeros((1, CELLS))] * 2,
            lambda bins: count_cells(views, [bins[:, :width], bins[:, width:]])[:, None])])

    def added_up(self, views: list[View], givers: list[list[Giver]]) -> list[np.ndarray]:
        width = len(views[0].edges)
        return self._sums(
            [np.zeros((len(v.beta), len(v.beta) + 2)) for v in views],
            lambda bins: add_up(views, givers, [bins[:, :width], bins[:, width:]]))


class QualityModel:
    """Both views and how they are combined."""

    def __init__(self, text: View, meta: View, combined: np.ndarray):
        self.text, self.meta, self.combined = text, meta, combined

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        both = np.stack([*(v.calibrated(v.bins(x)) for v, x in (
            (self.text, text), (self.meta, meta))), np.ones(len(text))], axis=1)
        return _sigmoid(both @ self.combined)


class Constant:
    """Stands in where the labels have one class or none."""

    def __init__(self, value: float):
        self.value = value

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return np.full(len(text), self.value)


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, held: np.ndarray,
             pool_of: Callable[[list[View]], Pool],
             by: CoTraining = CoTraining()) -> QualityModel | Constant:
    """``held`` marks the labelled rows for calibration; ``pool_of`` bins the other documents."""
    if min((label[part] == c).sum() for part in (~held, held) for c in (0, 1)) == 0:
        return Constant(float(label.mean() >= 0.5) if len(label) else 1.0)
    views = [View(text, by), View(meta, by)]
    bins = [view.bins(x) for view, x in zip(views, (text, meta))]
    y, share = label[~held], label[~held].mean()
    learned = [view.one_hot(b[~held]) for view, b in zip(views, bins)]
    for view, x in zip(views, learned):
        view.beta = _logistic(x, y, by.ridge)
    pool = pool_of(views)
    givers: list[list[Giver]] = [[], []]
    for _ in range(by.rounds):
        for view, b in zip(views, bins):
            view.calibrate(b[~held], y)
        for at, counts in enumerate(pool.counts(views)):
            givers[at].append(Giver(views[at], counts, share, by))
        for _ in range(by.steps):
            steps = []
            for view, x, sums in zip(views, learned, pool.added_up(views, givers)):
                weight = min(0.5, by.influence * len(y) / max(1.0, sums[0, -1]))
                slope, curve = _slope_and_curve(x, y, view.beta)
                steps.append(_step(view.beta, slope + weight * sums[:, -2],
                                   curve + weight * sums[:, :-2], by.ridge))
            for view, step in zip(views, steps):
                view.beta = view.beta - step
            if max(np.abs(step).max() for step in steps) < 1e-2:
                break
    for view, b in zip(views, bins):
        view.calibrate(b[held], label[held])
    both = np.stack([*(v.calibrated(b[held]) for v, b in zip(views, bins)), np.ones(held.sum())], axis=1)
    return QualityModel(*views, _logistic(both, label[held], 0.5))


def _columns(docs: DataFrame) -> list:
    return [F.col("text").cast("string"), F.col("lang").cast("string"),
            F.col("source").cast("string"), F.col("n_chars").cast("long")]


def train(docs: DataFrame, labels: DataFrame,
          by: CoTraining = CoTraining()) -> QualityModel | Constant:
    """Learn from ``labels`` (``doc_id, quality``). A document with several labels has their
    rounded mean; null labels count for nothing. Of the rows with one id, the one with the least text
    digest counts. All documents without a sampled label are exchanged, also those without an id,
    once where they have the same bins, so copies count as one."""
    ship_package(docs.sparkSession)
    by_id = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.round(F.avg("quality")).cast("double").alias("label"))
    # At most ``labelled`` rows of two numbers: a proven bound for the broadcast.
    sample = by_id.orderBy(F.xxhash64("doc_id"), "doc_id").limit(by.labelled).select(
        F.col("doc_id").alias("id"), "label")
    sampled = F.col("doc_id") == F.col("id")
    read = docs.select("doc_id", *_columns(docs))
    rows = (
        read.join(F.broadcast(sample), sampled)
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct(text_digest().alias("digest"), "text", "lang", "source", "n_chars")).alias("row"))
        .select("doc_id", "label", "row.*")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                both = np.hstack(features(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"),
                     pa.array(list(both), pa.list_(pa.float32()))], ["doc_id", "label", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = rows.mapInArrow(run, f"doc_id {kind}, label double, x array<float>").toArrow().sort_by("doc_id")
    if not seen.num_rows:
        return Constant(1.0)
    x = seen.column("x").combine_chunks().flatten().to_numpy().reshape(seen.num_rows, -1)
    label = seen.column("label").to_numpy(zero_copy_only=False).astype(float)
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 0
                     for i in seen.column("doc_id").to_pylist()])
    others = read.join(F.broadcast(sample), sampled, "left_anti")
    with intermediates(docs.sparkSession), tasks_for(read):
        return co_train(x[:, :N_TEXT], x[:, N_TEXT:], label, held,
                        lambda views: Pool(written(binned(others, views), "quality-bins")), by)


def binned(docs: DataFrame, views: list[View]) -> DataFrame:
    """The ``bins`` of both views, once where documents have the same ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                both = features(batch.slice(start, ROWS_AT_ONCE))
                bins = np.hstack([view.bins(x) for view, x in zip(views, both)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.tobytes() for row in bins], pa.binary())], ["bins"])

    return docs.mapInArrow(run, "bins binary").distinct()


def score_documents(docs: DataFrame, model, by: CoTraining = CoTraining()) -> DataFrame:
    """``doc_id, score, keep``: the probability of good quality of every document.

    Null texts are scored as empty ones, null metadata has a bin of its own. Equal rows have equal
    scores; other columns play no part. Without labels of both classes nothing is known, and every
    document has the labels' class, or is kept if there are no labels at all.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                score = model.score(*features(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score, pa.float64()),
                     pa.array(score >= by.threshold)], ["doc_id", "score", "keep"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *_columns(docs)).mapInArrow(
        run, f"doc_id {kind}, score double, keep boolean")


def keep_good(docs: DataFrame, model, by: CoTraining = CoTraining()) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with the same columns."""
    ship_package(docs.sparkSession)
    columns = docs.columns
    names = [unused(docs, f"quality_{c}") for c in ("text", "lang", "source", "n_chars")]
    wide = docs.select("*", *[c.alias(n) for c, n in zip(_columns(docs), names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                seen = pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names], ["text", "lang", "source", "n_chars"])
                good = model.score(*features(seen)) >= by.threshold
                yield part.select(columns).filter(pa.array(good))

    return wide.mapInArrow(run, docs.schema)
