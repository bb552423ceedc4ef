"""Toxicity by a bidirectional gated recurrent network over characters and words.

A word's vector has two parts: the pooled states of a character layer, and the word's own weight
where the sample knows the word. A word layer runs over overlapping windows of the text and is
pooled by attention; a document's logit is that of its highest window, calibrated for the number
of windows. Everything is trained in numpy on the driver, on a sample of bounded size:

1. Words and five-letter parts that toxic documents have far more often than others mark
   words; the character layer learns to tell them from the rest by their spelling.
2. The word layer learns from windows. A toxic document's label holds for its highest window, and
   each pass over the sample chooses that window anew.
3. Documents that neither step has seen calibrate the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.base import text_digest, text_or_empty
from almanac.llm.gru import Adam, BiGru, sigmoid
from almanac.session import ship_package

EDGES = ".,;:!?\"'()[]{}<>«»“”‘’…*&$%#|-_/\\"
LETTERS = 512
GRAM = 5


@dataclass(frozen=True)
class Toxicity:
    """``toxic``, ``clean`` and ``sample_bytes`` bound the sample of labelled rows. A class with fewer
    than ``least`` whole texts in it has excerpts of its long ones."""

    toxic: int = 1500
    clean: int = 3000
    sample_bytes: int = 16 << 20
    least: int = 50
    window: int = 64
    stride: int = 48
    word_chars: int = 20
    char_hidden: int = 12
    hidden: int = 12
    char_steps: int = 500
    word_steps: int = 400
    passes: int = 4
    cached_words: int = 200_000
    rows_at_once: int = 1024
    threshold: float = 0.5
    seed: int = 7


def words_of(text: str, longest: int) -> list[str]:
    """Words in lower case; longer ones in pieces, so that nothing of a text is left out."""
    words = text.lower().split()
    if max(map(len, words), default=0) > longest:
        words = [w[i:i + longest] for w in words for i in range(0, len(w), longest)]
    return words


def window_starts(n: int, by: Toxicity) -> range:
    return range(0, max(1, n - by.window + by.stride), by.stride)


def _as_rows(gates: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Projections as a table with a row for each input, from which rows are gathered."""
    return {side: np.ascontiguousarray(g.T) for side, g in gates.items()}


def _columns(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(table.take(rows, axis=0).T)


class ToxicModel:
    """The trained layers; scores batches of texts."""

    def __init__(self, by: Toxicity):
        rng = np.random.default_rng(by.seed)
        self.by = by
        self.letters = rng.standard_normal((LETTERS, 8)).astype(np.float32) * np.float32(0.5)
        self.chars = BiGru(8, by.char_hidden, rng)
        self.char_head = {"w": np.zeros(2 * by.char_hidden, np.float32),
                          "c": np.zeros(1, np.float32)}
        self.known: dict[str, float] = {}
        self.words = BiGru(2 * by.char_hidden + 2, by.hidden, rng)
        self.head = {"w": np.zeros(2 * by.hidden, np.float32), "c": np.zeros(1, np.float32)}
        self.calibration = np.array([1.0, 0.0, 0.0])
        self.forget()

    def forget(self) -> None:
        """Empty the memo of word vectors, whose row 0 stands for no word."""
        self.rows: dict[str, int] = {}
        self.gates: dict[str, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": {}, "gates": None}

    def spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letter numbers (steps, words) and their mask."""
        bare = [w.strip(EDGES) or w for w in words]
        lengths = np.array([len(w) for w in bare])
        steps = max(1, int(lengths.max(initial=0)))
        points = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), "<u4")
        inside = np.arange(steps)[None, :] < lengths[:, None]
        numbers = np.zeros((len(words), steps), np.int64)
        numbers[inside] = points % (LETTERS - 1) + 1
        return numbers.T, np.ascontiguousarray(inside.T).astype(np.float32)

    def word_vectors(self, words: list[str]) -> np.ndarray:
        """The words' vectors as columns."""
        numbers, mask = self.spelled(words)
        gates = _as_rows(self.chars.project(self.letters.T))
        pooled = self.chars.forward(lambda side, t: _columns(gates[side], numbers[t]), mask)
        logit = self.char_head["w"] @ pooled + self.char_head["c"]
        known = np.array([self.known.get(w.strip(EDGES), 0.0) for w in words], np.float32)
        return np.concatenate([pooled, logit[None] / 4, known[None]])

    def _numbered(self, texts: list[list[str]]) -> np.ndarray:
        """The memo's row of every word, one text behind the other."""
        every = set().union(*texts)
        new = every - self.rows.keys()
        if len(self.rows) + len(new) > self.by.cached_words:
            self.forget()
            new = every
        if self.gates is None:
            self.gates = _as_rows(self.words.project(
                np.zeros((2 * self.by.char_hidden + 2, 1), np.float32)))
        if new:
            ordered = sorted(new, key=len)
            first = len(self.gates["f"])
            parts = [_as_rows(self.words.project(self.word_vectors(
                ordered[i:i + self.by.rows_at_once])))
                for i in range(0, len(ordered), self.by.rows_at_once)]
            self.gates = {side: np.concatenate([self.gates[side], *(p[side] for p in parts)])
                          for side in "fb"}
            self.rows.update(zip(ordered, range(first, first + len(ordered))))
        return np.fromiter(map(self.rows.__getitem__, chain.from_iterable(texts)), np.int64)

    def window_logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows: the text's place, the start and the logit. A text without words has one
        window of nothing."""
        by, numbers = self.by, self._numbered(texts)
        ends = np.cumsum([len(w) for w in texts])
        spans = [(k, s, end - len(words) + s, end) for k, (words, end) in enumerate(
            zip(texts, ends)) for s in window_starts(len(words), by)]
        text, start, first, last = (np.array(x, np.int64) for x in zip(*spans))
        logits = np.zeros(len(spans), np.float32)
        padded = np.append(numbers, np.zeros(by.window, np.int64))
        for i in range(0, len(spans), by.rows_at_once):
            part = slice(i, i + by.rows_at_once)
            at = first[part][None, :] + np.arange(by.window)[:, None]
            mask = (at < last[part][None, :]).astype(np.float32)
            row = np.where(mask > 0, padded[np.minimum(at, len(padded) - 1)], 0)
            pooled = self.words.forward(
                lambda side, t: _columns(self.gates[side], row[t]), mask)
            logits[part] = self.head["w"] @ pooled + self.head["c"]
        return text, start, logits

    def document_logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The highest window's logit of each text and its number of windows."""
        text, _, logits = self.window_logits(texts)
        highest = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(highest, text, logits)
        return highest, np.bincount(text, minlength=len(texts))

    def score(self, texts: list[str]) -> np.ndarray:
        words = [words_of(t, self.by.word_chars) for t in texts]
        highest, windows = self.document_logits(words)
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * highest + b * np.log(windows) + c, -30, 30)))


class ConstantModel:
    """Stands in where the sample has one class or none."""

    def __init__(self, value: float):
        self.value = value

    def score(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.value)


def _excess(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Standard deviations by which toxic documents have something too often; 0 below fivefold."""
    expected = (toxic + clean) * share
    z = (toxic - expected) / np.sqrt(expected + 1)
    often = toxic * (1 - share) >= 5 * (clean + 0.2) * share
    return np.where(often, z, 0.0)


def _marked_words(bags: list[set[str]], toxic: np.ndarray) -> tuple[list[str], np.ndarray,
                                                                   dict[str, float]]:
    """Words of the sample, whether they are marked as toxic, and the weights of known words."""
    share = float(toxic.mean())
    counts = [Counter(), Counter()]
    for bag, label in zip(bags, toxic):
        counts[int(label)].update(bag)
    words = sorted(counts[0].keys() | counts[1].keys())
    number = {w: i for i, w in enumerate(words)}
    n_clean, n_toxic = (np.array([c[w] for w in words]) for c in counts)
    gram_number: dict[str, int] = {}
    grams = [np.array(sorted({gram_number.setdefault(f"^{w}$"[i:i + GRAM], len(gram_number))
                              for i in range(max(1, len(w) + 3 - GRAM))}), np.int64)
             for w in words]
    seen = np.zeros((2, len(gram_number)), np.int64)
    for bag, label in zip(bags, toxic):
        if bag:
            seen[int(label), np.unique(np.concatenate([grams[number[w]] for w in bag]))] += 1
    gram_z = _excess(seen[1], seen[0], share)
    word_z = _excess(n_toxic, n_clean, share)
    by_gram = np.array([gram_z[g].max() for g in grams])
    marked = (word_z >= 4) | ((by_gram >= 4.5) & (n_toxic * (1 - share) >= 2 * n_clean * share))
    known = {w: min(1.0, z / 8) for w, z in zip(words, word_z) if z >= 4}
    return words, marked, known


def _train_chars(model: ToxicModel, words: list[str], marked: np.ndarray,
                 rng: np.random.Generator) -> None:
    pools = [np.flatnonzero(~marked), np.flatnonzero(marked)]
    optimiser = Adam()
    for _ in range(model.by.char_steps):
        chosen = np.concatenate([rng.choice(p, 96) for p in pools])
        y = marked[chosen].astype(np.float32)
        numbers, mask = model.spelled([words[i] for i in chosen])
        x = model.letters[numbers].transpose(0, 2, 1)
        gates, keep = model.chars.project(x), {}
        pooled = model.chars.forward(lambda side, t: gates[side][t], mask, keep)
        error = (sigmoid(model.char_head["w"] @ pooled + model.char_head["c"]) - y) / len(y)
        grads, by_x = model.chars.backward(x, keep, error * model.char_head["w"][:, None])
        letters = np.zeros_like(model.letters)
        np.add.at(letters, numbers, by_x.transpose(0, 2, 1))
        params = model.chars.params | model.char_head | {"letters": model.letters}
        optimiser.update(params, grads | {
            "w": pooled @ error, "c": error.sum(keepdims=True), "letters": letters})


def _train_words(model: ToxicModel, texts: list[list[str]], toxic: np.ndarray,
                 rng: np.random.Generator) -> None:
    by, optimiser = model.by, Adam()
    spelled = sorted({w for words in texts for w in words}, key=len)
    row = {w: i for i, w in enumerate(spelled, 1)}
    numbers = [np.fromiter(map(row.__getitem__, words), np.int32) for words in texts]
    vectors = np.concatenate(  # column 0 stands for no word
        [np.zeros((2 * by.char_hidden + 2, 1), np.float32),
         *(model.word_vectors(spelled[i:i + by.rows_at_once])
           for i in range(0, len(spelled), by.rows_at_once))], axis=1)
    evidence = vectors[-2] + vectors[-1]
    # The first choice of windows is by their words, later ones by the model.
    highest = [max(window_starts(len(n), by), key=lambda s: evidence[n[s:s + by.window]].max(
        initial=0.0)) for n in numbers]
    for turn in range(by.passes):
        if turn:
            model.forget()
            for i in range(0, len(texts), 256):
                text, start, logits = model.window_logits(texts[i:i + 256])
                order = np.lexsort((logits, text))
                last = np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)
                for k in order[last]:
                    highest[i + text[k]] = int(start[k])
        pools = [np.flatnonzero(~toxic), np.flatnonzero(toxic)]
        for _ in range(by.word_steps // by.passes):
            chosen = np.concatenate([rng.choice(p, 48) for p in pools])
            y = toxic[chosen].astype(np.float32)
            starts = [highest[k] if toxic[k] or rng.random() < 0.5 else int(rng.choice(
                window_starts(len(texts[k]), by))) for k in chosen]
            parts = [numbers[k][s:s + by.window] for k, s in zip(chosen, starts)]
            at = np.zeros((max(1, max(map(len, parts))), len(parts)), np.int32)
            for k, part in enumerate(parts):
                at[:len(part), k] = part
            x, mask = vectors[:, at].transpose(1, 0, 2), (at > 0).astype(np.float32)
            gates, keep = model.words.project(x), {}
            pooled = model.words.forward(lambda side, t: gates[side][t], mask, keep)
            error = (sigmoid(model.head["w"] @ pooled + model.head["c"]) - y) / len(y)
            grads, _ = model.words.backward(x, keep, error * model.head["w"][:, None])
            optimiser.update(model.words.params | model.head, grads | {
                "w": pooled @ error, "c": error.sum(keepdims=True)})
    model.forget()


def _calibrate(model: ToxicModel, texts: list[list[str]], toxic: np.ndarray,
               weight: np.ndarray) -> None:
    """Logistic regression on the highest logit and the logarithm of the number of windows."""
    parts = [model.document_logits(texts[i:i + 256]) for i in range(0, len(texts), 256)]
    highest, windows = (np.concatenate(x) for x in zip(*parts))
    x = np.stack([highest, np.log(windows), np.ones(len(texts))], axis=1).astype(float)
    weight = weight / weight.mean()
    beta = start = np.array([1.0, 0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + beta - start
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(3)
        step = np.linalg.solve(curve, slope)
        beta = beta - step / max(1.0, np.abs(step).max())  # far steps overshoot
    model.calibration = beta
    model.forget()


def fit(texts: list[str], toxic: np.ndarray, calibrating: np.ndarray, weight: np.ndarray,
        by: Toxicity = Toxicity()) -> ToxicModel | ConstantModel:
    """Train on a sample. ``calibrating`` marks the documents that are kept for the last step,
    ``weight`` how many documents each one stands for."""
    toxic = np.asarray(toxic, bool)
    learn = ~calibrating
    if not len(texts) or min((toxic[part] == c).sum()
                             for part in (learn, calibrating) for c in (False, True)) == 0:
        return ConstantModel(float(weight[toxic].sum() > weight.sum() / 2) if len(texts) else 0.0)
    rng = np.random.default_rng(by.seed)
    one: dict[str, str] = {}  # equal words share one object
    words = [[one.setdefault(w, w) for w in words_of(t, by.word_chars)] for t in texts]
    mine = [w for w, part in zip(words, learn) if part]
    bags = [{one.setdefault(b, b) for b in (w.strip(EDGES) or w for w in ws)} for ws in mine]
    model = ToxicModel(by)
    spelled, marked, model.known = _marked_words(bags, toxic[learn])
    del bags
    if marked.any() and not marked.all():
        _train_chars(model, spelled, marked, rng)
    _train_words(model, mine, toxic[learn], rng)
    held = [w for w, part in zip(words, calibrating) if part]
    _calibrate(model, held, toxic[calibrating], weight[calibrating])
    return model


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is never learned from: the CRC of its id as text is divisible by 5."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))


def excerpt(text: str, size: int, pieces: int = 32) -> str:
    """About ``size`` bytes of a text: pieces at equal distances, without words that they cut."""
    size = size * len(text) // max(1, len(text.encode()))
    each = max(1, size // pieces)
    if len(text) <= max(size, each * pieces):
        return text
    out = []
    for start in (k * (len(text) - each) // (pieces - 1) for k in range(pieces)):
        end = start + each
        words = text[start:end].split()
        if len(words) > 2:
            words = words[0 if start == 0 or text[start - 1].isspace() else 1:
                          None if end == len(text) or text[end].isspace() else -1]
        out += words
    return " ".join(out)


def _chosen(parts: list[pa.Table], by: Toxicity) -> pa.Table:
    """The rows of each class that fit its share of the bytes, and whether their text is whole.

    A class has half of the bytes, or what the other one leaves. Short texts come first, so a long
    one takes no other's place. If fewer than ``least`` fit, long texts count as excerpts, of which
    half of the bytes hold that many.
    """
    longest, out = by.sample_bytes // 100, []
    size = [np.asarray(part.column("bytes").to_pylist(), np.int64) for part in parts]
    for part, mine, other in zip(parts, size, size[::-1]):
        room = max(by.sample_bytes // 2, by.sample_bytes - int(other.sum()))
        fits = np.cumsum(mine) <= room
        whole = np.ones(len(mine), bool)
        if fits.sum() < min(by.least, len(mine)):
            whole = mine <= longest
            fits = np.cumsum(np.minimum(mine, longest)) <= room
        out.append(part.append_column("whole", pa.array(whole)).filter(pa.array(fits)))
    return pa.concat_tables(out)


def train(docs: DataFrame, labels: DataFrame,
          by: Toxicity = Toxicity()) -> ToxicModel | ConstantModel:
    """Learn from ``labels`` (``doc_id, toxic``), of which held-out rows are left out.

    A document with several labels is toxic if one says so, one with several texts has that of the
    least digest. The sample is the first rows by a hash of their ids, up to a number of each class
    and of bytes; long texts come last. Rows with a null id aren't learned from.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    by_id = known.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("toxic").cast("int")).alias("label"))
    sizes = docs.select("doc_id", F.struct(
        text_digest().alias("digest"), F.octet_length(text_or_empty()).alias("bytes")).alias("row"))
    found = by_id.join(sizes, F.col("id") == F.col("doc_id")).groupBy("id", "label").agg(
        F.min("row").alias("row")).select("id", "label", "row.digest", "row.bytes")
    totals = {r["label"]: r["n"] for r in by_id.groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    longest = by.sample_bytes // 100
    order = [F.when(F.col("bytes") > longest, F.col("bytes")).otherwise(0), F.xxhash64("id"),
             F.col("id")]
    # At most toxic + clean rows of four values: the driver and a broadcast are bounded.
    parts = [found.where(F.col("label") == c).orderBy(*order).limit(n).toArrow()
             for c, n in ((0, by.clean), (1, by.toxic))]
    sample = spark.createDataFrame(_chosen(parts, by), found.withColumn("whole", F.lit(True)).schema)
    chosen = (
        docs.select("doc_id", "text", text_digest().alias("text_digest"))
        .join(F.broadcast(sample), (F.col("doc_id") == F.col("id"))
              & (F.col("text_digest") == F.col("digest")))
        .groupBy("id", "label", "whole").agg(F.first("text").alias("text"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if whole else excerpt(t or "", longest) for t, whole in zip(
                batch.column("text").to_pylist(), batch.column("whole").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(texts, pa.string())],
                ["id", "label", "text"])

    kind = found.schema["id"].dataType.simpleString()
    rows = chosen.mapInArrow(cut, f"id {kind}, label int, text string").toArrow()
    rows = rows.sort_by("id")
    label = np.array(rows.column("label").to_pylist(), int)
    weight = np.array([totals[c] / max(1, (label == c).sum()) for c in (0, 1)]) if len(label) \
        and set(totals) == {0, 1} else np.ones(2)
    texts = [t or "" for t in rows.column("text").to_pylist()]
    calibrating = np.array([zlib.crc32(t.encode()) % 5 == 0 for t in texts], bool)
    return fit(texts, label, calibrating, weight[label] if len(label) else np.ones(0), by)


def score_documents(docs: DataFrame, model: ToxicModel | ConstantModel,
                    by: Toxicity = Toxicity()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, from all windows of its text.

    A null text is scored as an empty one, a null id isn't held out. Equal texts have equal scores
    up to rounding; other columns play no part; no documents give no rows. Without
    labels of both classes every score is the class that there is, or 0.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                score = model.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score, pa.float64()),
                     pa.array((score >= by.threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def _parts(batch: pa.RecordBatch, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of characters, or one text."""
    start = total = 0
    for at, size in enumerate(len(t or "") for t in batch.column("text").to_pylist()):
        if at > start and total + size > chars:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
